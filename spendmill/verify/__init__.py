"""Every operator as a query over the driver tables, with the same result stated as independent SQL."""
