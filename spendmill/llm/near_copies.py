"""Near copies: texts whose sets of word shingles have a Jaccard similarity of `LEAST` = 0.8 or more.

Candidates are found in two steps. A text's signature has the minima of its shingle hashes under `BANDS` * `ROWS` = 128
multiplications; two texts of similarity 0.8 share one of the 32 bands of four minima with a probability of
1 - (1 - 0.8 ** 4) ** 32, all but 5 in 100 million. Only texts that share a band with another one go on.

Those are joined by a prefix filter. Shingles have one order, rarest first, by the number of texts that hold them. Two sets of
similarity 0.8 have a common shingle among the first n - ceil(4 n / 5) + 1 of the larger and the first n - ceil(8 n / 9) + 1 of
the smaller one, so only these are listed. Shingles of one text alone come first and are listed nowhere: texts of one
template, each with words of its own, never meet. A pair whose common shingle stands too far back in either set to leave 4/9 of
both sizes is no candidate. Every link is verified by the exact similarity of the shingle sets.

In each list every member is first compared with the smallest one, so a group of copies gives as many pairs as members. Lists
whose members are then still in several components are compared between the components only. No list has a bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from spendmill.llm.common import Workspace, fresh_name
from spendmill.llm.components import connected_components
from spendmill.llm.simhash import majority_bits, rows_to_drop, shingle_hashes, signed

LEAST = (4, 5)
BANDS, ROWS = 32, 4
_RANDOM = np.random.default_rng(42)
FACTORS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MIX = _RANDOM.integers(0, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """The distinct shingle hashes, sorted."""
    return np.unique(shingle_hashes(text, shingle).astype(np.uint64))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """One key per band, its place included; no shingles give no keys."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    minima = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 4096):
        # The high half of the first product is folded in, as low bits of a product depend on low bits only.
        product = hashes[at : at + 4096, None] * FACTORS
        minima = np.minimum(minima, ((product ^ (product >> np.uint64(32))) * FACTORS).min(axis=0))
    mixed = np.zeros(BANDS, np.uint64)
    for row in range(ROWS):
        mixed = (mixed ^ (mixed >> np.uint64(29)) ^ minima[row::ROWS]) * MIX[row]
    return ((mixed ^ (mixed >> np.uint64(31))) * FACTORS[:BANDS]).view(np.int64)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of `pairs` (`a`, `b`: nodes, distinct) whose sets have a similarity of `LEAST` or more."""
    side = lambda c: sets.select(F.col("node").alias(c), F.col("shingles").alias(f"{c}_set"))
    both = F.size(F.array_intersect("a_set", "b_set"))
    either = F.size("a_set") + F.size("b_set") - both
    return pairs.join(side("a"), "a").join(side("b"), "b").where(LEAST[1] * both >= LEAST[0] * either).select("a", "b")


def listed_heads(sets: DataFrame, work: Workspace) -> DataFrame:
    """Shingles by which sets can meet: `s`, `node`, `n` (size of the set), `at` (place in its order), `indexed`.

    `indexed` ones are also among the first of the set as the smaller one of a pair.
    """
    held = sets.select("node", F.explode("shingles").alias("s"))
    shared = work.write(held.groupBy("s").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1"), "shared")
    common = held.join(shared, "s").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("texts", "s"))).alias("common"))
    sized = common.join(sets.select("node", F.size("shingles").alias("n")), "node")
    own = F.col("n") - F.size("common")
    first = sized.select(
        "node",
        "n",
        own.alias("own"),
        F.expr("n - (4 * n + 4) div 5 + 1").alias("probed"),
        F.expr("n - (8 * n + 8) div 9 + 1").alias("kept"),
        "common",
    ).where("probed > own")
    heads = first.select(
        "node", "n", "own", "kept", F.posexplode(F.expr("slice(common, 1, int(probed - own))")).alias("place", "entry")
    )
    at = F.col("own") + F.col("place")
    return heads.select(F.col("entry.s").alias("s"), "node", "n", at.alias("at"), (at < F.col("kept")).alias("indexed"))


def _can_reach(small: str, large: str) -> Column:
    """Whether sets of these sizes can be similar when their first common shingle stands at these places."""
    n, m = F.col(f"{small}_n"), F.col(f"{large}_n")
    least = F.least(n - F.col(f"{small}_at"), m - F.col(f"{large}_at"))
    return (LEAST[1] * n >= LEAST[0] * m) & ((LEAST[0] + LEAST[1]) * least >= LEAST[0] * (n + m))


def near_copy_links(distinct: DataFrame, rows: DataFrame, number: str, shingle: int, work: Workspace) -> DataFrame:
    """`node` and `root` of every text that has a near copy. `distinct` has a `node` and its `bands` per set of shingles."""

    def computed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(text, shingle).view(np.int64) for text in batch.column("text").to_pylist()]
            column = pa.array(sets, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("node"), column], names=["node", "shingles"])

    listed = work.write(distinct.select("node", F.explode("bands").alias("key")), "lists")
    groups = listed.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    groups = work.write(groups.select("key"), "groups")
    nodes = work.write(listed.join(groups, "key", "left_semi").select("node").distinct(), "nodes")
    work.drop("lists", "groups")
    texts = rows.select(F.col(number).alias("node"), "text").join(nodes, "node", "left_semi")
    sets = work.write(texts.mapInArrow(computed, "node long, shingles array<bigint>"), "sets")
    heads = work.write(listed_heads(sets, work), "heads")
    work.drop("shared", "nodes")

    first = F.min(F.struct(F.col("n").alias("b_n"), F.col("node").alias("b"), F.col("at").alias("b_at"))).alias("first")
    firsts = work.write(heads.where("indexed").groupBy("s").agg(first).select("s", "first.*"), "leads")
    probes = heads.select("s", F.col("node").alias("a"), F.col("n").alias("a_n"), F.col("at").alias("a_at"))
    later = F.struct("b_n", "b") < F.struct("a_n", "a")
    stars = work.write(probes.join(firsts, "s").where(later & _can_reach("b", "a")).select("a", "b").distinct(), "stars")
    links = work.write(verified(stars, sets), "links")
    roots = connected_components(links, work, "star_links")

    rooted = heads.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = work.write(rooted, "rooted")
    several = rooted.groupBy("s").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    left = work.write(rooted.join(work.write(several.select("s"), "several"), "s"), "left")
    small = left.where("indexed").select(
        "s", F.col("node").alias("b"), F.col("root").alias("b_root"), F.col("n").alias("b_n"), F.col("at").alias("b_at")
    )
    large = left.select(
        "s", F.col("node").alias("a"), F.col("root").alias("a_root"), F.col("n").alias("a_n"), F.col("at").alias("a_at")
    )
    apart = (F.col("a_root") != F.col("b_root")) & later & _can_reach("b", "a")
    crossed = large.join(small, "s").where(apart).select("a", "b").distinct()
    crossed = work.write(crossed.join(stars, ["a", "b"], "left_anti"), "crossed")
    more = work.write(verified(crossed, sets), "more")
    return roots if more.isEmpty() else connected_components(links.unionByName(more), work, "all_links")


def drop_near_copies(docs: DataFrame, shingle: int, fingerprints: bool = False) -> DataFrame:
    """The rows of `docs`, all columns, of which one stays per group of near copies: the one with the smallest document id.

    Groups are closed under links. Nulls come last; of rows with that id, one stays. Texts without words are one group, texts
    shorter than a shingle have one shingle of all their words. With `fingerprints`, those that `simhash.drop_near_duplicates`
    drops go first, and only the others are compared.

    Shingles are hashed once for all marks. The rows are written once with a row number, so that the number of a row to drop
    means the same row when they are read again. The numbers of dropped rows are joined, not those of kept ones: they are
    fewer, and while they fit into a broadcast no text is shuffled.
    """
    work = Workspace(docs.sparkSession, "near_copies")
    names = [fresh_name(docs, name) for name in ("set_key", "bands", "fp", "row_number")]
    set_key, bands, fp, number = names

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            hashes = [shingle_hashes(text, shingle) for text in batch.column("text").to_pylist()]
            prints = pa.array([signed(majority_bits(h)) if fingerprints else None for h in hashes], pa.int64())
            sets = [np.unique(h.astype(np.uint64)) for h in hashes]
            keys = pa.array([xxhash.xxh3_128_digest(s.tobytes()).hex() for s in sets], pa.string())
            lists = pa.array([band_keys(s) for s in sets], pa.list_(pa.int64()))
            columns = [*batch.columns, keys, lists, prints]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, set_key, bands, fp])

    marks = [StructField(set_key, docs.schema["text"].dataType), StructField(bands, ArrayType(LongType())), StructField(fp, LongType())]
    schema = StructType([*docs.schema.fields, *marks])
    rows = work.write(docs.mapInArrow(marked, schema).withColumn(number, F.monotonically_increasing_id()), "rows")
    compared = rows.select("doc_id", F.col(set_key).alias("set_key"), F.col(number).alias("node"))
    if fingerprints:
        prints = rows.select("doc_id", F.col(fp).alias("fp"), F.col(number).alias("row"))
        before = Workspace(docs.sparkSession, "simhash")
        by_fingerprint = work.write(rows_to_drop(prints, before).withColumnRenamed("row", "node"), "by_fingerprint")
        Workspace.release([before])
        compared = compared.join(by_fingerprint, "node", "left_anti")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("node").alias("row"))
    # The first row of each set of shingles stands for it.
    firsts = compared.groupBy("set_key").agg(F.min(order).alias("first"))
    firsts = work.write(firsts.select(F.col("first.row").alias("node"), "first"), "firsts")
    distinct = work.write(
        rows.select(F.col(number).alias("node"), F.col(bands).alias("bands")).join(firsts.select("node"), "node"), "distinct"
    )
    roots = near_copy_links(distinct, rows, number, shingle, work)
    work.drop("distinct")
    keep = (
        firsts.join(roots, "node", "left")
        .groupBy(F.coalesce("root", "node").alias("root"))
        .agg(F.min("first").alias("first"))
        .select(F.col("first.row").alias(number))
    )
    drop = work.write(rows.select(number).join(work.write(keep, "keep"), number, "left_anti"), "drop")
    return rows.join(drop, number, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
