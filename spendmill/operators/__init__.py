"""Table operators: incremental windows, keep-first dedupe, slice replace, full refresh, failure isolation."""
