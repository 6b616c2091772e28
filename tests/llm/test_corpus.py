"""Corpus operators against brute force and DuckDB, and their defined results for odd inputs."""

import os
import random
import time

import numpy as np
import pandas as pd
import pytest
from public_tokenizers import path
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from spendmill.llm import decontamination, html_text, near_copies, packing, quality_rules, simhash, windows
from spendmill.llm.line_dedup import remove_repeated_lines
from spendmill.llm.license_scan import TEMPLATES, scan_licences, summarise
from spendmill.llm.oracles import ORACLES
from spendmill.llm.queries import QUERIES
from spendmill.llm.substring_dedup import remove_repeated_windows
from spendmill.llm.suffix_dedup import remove_repeated_bytes
from spendmill.llm.token_counts import count_tokens
from spendmill.session import scoped_conf
from spendmill.verify.compare import differences
from tests.llm import brute

SF_DIR = os.environ.get("SPENDMILL_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
        # Names that the operators use inside.
        *(StructField(name, StringType()) for name in ("words", "k1", "fp", "row", "row_number", "line_dedup", "places", "kept")),
    ]
)


def docs_of(spark, rows):
    full = [(doc, text, "en", "s", len(text or ""), *["x"] * 8) for doc, text in rows]
    return spark.createDataFrame(full, SCHEMA)


def odd_rows():
    """Nulls, empty and blank texts, one word, copies, repeated rows, a long text, and shared passages."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)] + ["É", "ß", "the", "ＦＷ"]
    passage = " ".join(rng.choice(words) for _ in range(60))
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (None, text(40)), (None, None), (5, passage), (6, passage), (6, passage)]
    rows += [(10 + i, f"{text(30)}\n{passage}\n{text(20)}") for i in range(4)]
    rows += [(20, text(3000)), (21, "again and again " * 80), (22, "x" * 1500), (23, passage.replace("w1", "v1"))]
    base = text(200)
    rows += [(30 + i, base.replace(" the ", " a ", i)) for i in range(4)]
    return rows


def got(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("rows", [[], odd_rows()], ids=["empty", "odd"])
def test_substring_dedup(spark, rows):
    out = remove_repeated_windows(docs_of(spark, rows))
    assert got(out, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute.substring_dedup(rows, 35), key=repr)


@pytest.mark.parametrize("bound", [50_000, 1])
def test_suffix_dedup(spark, bound):
    rows = odd_rows()
    out = remove_repeated_bytes(docs_of(spark, rows), group_bound=bound)
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got(out, *columns) == sorted(brute.suffix_dedup(rows, 200), key=repr)


def test_suffix_dedup_oversize_groups(spark, monkeypatch):
    import spendmill.llm.suffix_dedup as module

    monkeypatch.setattr(module, "BATCH_CONTEXTS", 4)
    rng = random.Random(1)
    shared = "".join(rng.choice("abcdef") for _ in range(230))
    rows = [(i, "".join(rng.choice("abcdef") for _ in range(150)) + shared + "".join(rng.choice("abcdef") for _ in range(99))) for i in range(40)]
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    for bound in (2, 10_000):
        out = module.remove_repeated_bytes(docs_of(spark, rows), group_bound=bound)
        assert got(out, *columns) == sorted(brute.suffix_dedup(rows, 200), key=repr)


def test_owners_cover_every_window_once():
    units = np.random.default_rng(3).integers(1, 4, 500).astype(np.uint64)
    starts = [x for _, _, first, last in windows.owners(units, 9, 35) for f, e in zip(first, last) for x in range(f, e + 1)]
    assert starts == list(range(466))


def test_owners_of_a_long_sequence(monkeypatch):
    units = np.random.default_rng(3).integers(1, 1000, 5000).astype(np.uint64)
    whole = [x for o, _, f, e in windows.owners(units, 9, 35) for a, b, c in zip(o, f, e) for x in [a] * (c - b + 1)]
    monkeypatch.setattr(windows, "CHUNK", 1 << 10)
    parts = [x for o, _, f, e in windows.owners(units, 9, 35) for a, b, c in zip(o, f, e) for x in [a] * (c - b + 1)]
    assert whole == parts


@pytest.mark.parametrize("rows", [[], odd_rows()], ids=["empty", "odd"])
def test_simhash(spark, rows):
    prints = [(doc, brute.simhash(text)) for doc, text in rows]
    least = brute.components(prints)
    expected = sorted(((doc, f"{fp:016x}", least[fp]) for doc, fp in prints), key=repr)
    assert got(simhash.near_duplicates(docs_of(spark, rows)), "doc_id", "fingerprint", "component_id") == expected


@pytest.mark.parametrize("bound", [4096, 3])
def test_fingerprint_links_in_long_lists(spark, bound, monkeypatch, tmp_path):
    monkeypatch.setattr(simhash, "LIST_BOUND", bound)
    rng = random.Random(2)
    values = {rng.getrandbits(64) for _ in range(60)}
    for v in list(values)[:25]:
        for _ in range(6):
            v ^= sum({1 << rng.randrange(64) for _ in range(4)})
            values.add(v)
    prints = [(i, v) for i, v in enumerate(sorted(values))]
    df = spark.createDataFrame([(i, simhash.signed(v)) for i, v in prints], "doc_id long, fp long")
    found = simhash.components_of(df, simhash.Workspace(spark, "test"))
    assert {r.fp: r.component_id for r in found.collect()} == {simhash.signed(v): c for v, c in brute.components(prints).items()}


def test_drop_near_duplicates_keeps_one_of_each_group(spark):
    rows = odd_rows()
    docs = docs_of(spark, rows)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    least = brute.components([(doc, brute.simhash(text)) for doc, text in rows])
    groups = {brute.simhash(text): least[brute.simhash(text)] for _, text in rows}
    ids = sorted((r.doc_id for r in kept.select("doc_id").collect()), key=repr)
    assert ids == sorted(set(groups.values()) | {None}, key=repr)  # one text stands under a null id only


def near_copy_rows():
    """Groups of copies with a few words changed, chains of them, texts around the bound, and odd texts."""
    rng = random.Random(8)
    text = lambda n: [f"w{rng.randrange(900)}" for _ in range(n)]
    rows, doc = odd_rows(), 100
    for changes in range(9):
        base = text(120)
        for copy in range(6):
            own = list(base)
            for _ in range(changes * (copy > 0)):
                own[rng.randrange(len(own))] = f"v{rng.random()}"
            rows.append((doc, " ".join(own)))
            doc += 1
    chain = text(150)
    for step in range(12):
        chain = [*chain[4:], *text(4)]
        rows.append((doc + step, " ".join(chain)))
    rng.shuffle(rows)
    return rows


def test_near_copies_of_similarity_08_go(spark):
    rows = near_copy_rows()
    docs = docs_of(spark, rows)
    expected = brute.near_copies(rows, 5)
    kept = near_copies.drop_near_copies(docs, 5)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(expected, key=repr)
    fingerprints = brute.components([(i, brute.simhash(text, 5)) for i, (_, text) in enumerate(rows)])
    assert len(expected) < len(set(fingerprints.values()))
    assert near_copies.drop_near_copies(docs_of(spark, []), 5).count() == 0


def candidate_pairs(spark, rows, monkeypatch):
    """Pairs that are compared in full, and the links found."""
    seen, plain = [], near_copies.verified

    def counted(pairs, sets):
        seen.append(pairs.count())
        return plain(pairs, sets)

    monkeypatch.setattr(near_copies, "verified", counted)
    kept = near_copies.drop_near_copies(docs_of(spark, rows), 5).count()
    monkeypatch.undo()
    return sum(seen), kept


def test_texts_of_one_template_are_not_compared_pairwise(spark, monkeypatch):
    """Words of their own keep texts apart whose similarity stays under 0.8, however many share a template."""
    rng = random.Random(4)
    base = [f"w{rng.randrange(900)}" for _ in range(150)]
    rows = []
    for doc in range(200):
        own = list(base)
        for place in rng.sample(range(3, 147), 8):
            own[place] = f"v{rng.random()}"
        rows.append((doc, " ".join(own)))
    expected = len(brute.near_copies(rows, 5))
    compared, kept = candidate_pairs(spark, rows, monkeypatch)
    assert kept == expected and compared <= 4 * len(rows)


def test_a_group_of_copies_is_compared_with_few_texts(spark, monkeypatch):
    rng = random.Random(4)
    base = [f"w{rng.randrange(900)}" for _ in range(150)]
    rows = []
    for doc in range(200):
        own = list(base)
        own[rng.randrange(150)] = f"v{rng.random()}"
        rows.append((doc, " ".join(own)))
    compared, kept = candidate_pairs(spark, rows, monkeypatch)
    assert kept == 1 and compared <= 6 * len(rows)


def test_pipeline_leaves_no_near_copies(spark, tmp_path):
    import corpus_pipeline

    rows = near_copy_rows()
    spark.createDataFrame([(7, "no such item in any of these texts")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = docs_of(spark, rows)
    for _, stage in corpus_pipeline.STAGES[2:3]:
        docs = corpus_pipeline.Workspace(spark, "test").write(stage(spark, docs, str(tmp_path)), "near")
    left = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert len(brute.near_copies(left, 5)) == len(left) < len({text for _, text in rows})


def test_near_duplicate_stage_moves_no_texts(spark, monkeypatch):
    """The texts are written once, and the few dropped rows are taken out without a shuffle of all rows."""
    import corpus_pipeline

    rng = random.Random(6)
    rows = [(doc, " ".join(f"w{rng.randrange(900)}" for _ in range(60))) for doc in range(3000)]
    rows += [(5000 + doc, text) for doc, text in rows[:20]]
    with_text, plain = [], corpus_pipeline.Workspace.write

    def noted(work, df, name, *more):
        with_text.extend([name] if "text" in df.columns else [])
        return plain(work, df, name, *more)

    monkeypatch.setattr(corpus_pipeline.Workspace, "write", noted)
    with scoped_conf(spark, spark__sql__autoBroadcastJoinThreshold="10k"):
        after = corpus_pipeline.near_duplicates(spark, docs_of(spark, rows), SF_DIR)
        plan = after._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.doc_id for r in after.collect()) == list(range(3000))
    assert with_text == ["rows"]
    assert "Exchange hashpartitioning" not in plan


@pytest.mark.parametrize("name", ["op5", "op6", "op7"])
def test_empty_tables(spark, name):
    empty = docs_of(spark, [])
    if name == "op7":
        empty = spark.createDataFrame([], "page_id long, url string, html string")
        assert html_text.extract_main_text(empty).count() == 0
    elif name == "op5":
        assert count_tokens(empty, path("piece_bpe_32k.model")).count() == 0
    else:
        assert packing.pack_documents(empty, path("word_bpe_49k.json")).count() == 0


def strange_texts():
    rows = [text for _, text in odd_rows()]
    return rows + ["<s>x</s>\x00", "a  b   c\r\n\n▁▁d ▁", " lead", "trail ", "<|endoftext|>a<|startoftext|>", "İ Σς K é", "a\x1cb\x85c　d"]


def test_token_counts(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    rows = list(enumerate(strange_texts()))
    expected = [(i, len((t or "").encode()), len(model.encode(t or "", num_threads=1))) for i, t in rows]
    assert got(count_tokens(docs_of(spark, rows), path("piece_bpe_32k.model")), "doc_id", "n_bytes", "n_tokens") == sorted(expected, key=repr)


def test_packing(spark):
    import zlib

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path("word_bpe_49k.json"))
    rows = list(enumerate(strange_texts()))
    expected = []
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), 64)):
            own = np.array(ids[start : start + 64], "<u4")
            expected.append((i, piece, start, len(own), zlib.crc32(own.tobytes())))
    packed = packing.pack_documents(docs_of(spark, rows), path("word_bpe_49k.json"), limit=64).cache()
    assert got(packed, "doc_id", "piece", "start", "length", "ids_crc32") == sorted(expected, key=repr)
    bins = {}
    for r in packed.collect():
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 64
    assert len(bins) <= 1.05 * sum(e[3] for e in expected) / 64 + 1


def test_best_two_fit_exchanges_the_smallest():
    bins, _ = packing.best_two_fit(np.array([6, 3, 2, 2]), 10)
    # 6 + 3 leaves a gap of 1; 2 + 2 fill it better than 3.
    assert bins[0] == bins[2] == bins[3] != bins[1]


@pytest.mark.parametrize("sizes, groups", [([], []), ([0, 3], [3]), ([15], [15]), ([16], [10, 6]), ([7] * 6, [10, 10, 10, 12]), ([45], [10, 10, 10, 15])])
def test_groups_of_a_task(sizes, groups):
    ends = np.cumsum([0, *sizes])
    batches = [pd.DataFrame({"length": np.arange(a, b)}) for a, b in zip(ends, ends[1:])]
    found = list(packing.even_groups(iter(batches), 10))
    assert [len(g) for g in found] == groups
    assert [n for g in found for n in g["length"]] == list(range(sum(sizes)))
    assert all(list(g.index) == list(range(len(g))) for g in found)


def test_one_task_packs_many_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ITEMS", 20)
    monkeypatch.setattr(packing, "GROUPS_PER_TASK", 100)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        rows = [(i, "word " * (i % 40)) for i in range(300)]
        out = packing.pack_documents(docs_of(spark, rows), path("word_bpe_49k.json"), 64).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    bins = {}
    for r in out:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 64
    assert len({r.doc_id for r in out}) == 300 and len({s >> 32 for s in bins}) == 2
    # Each of the 15 groups of 20 may leave one sequence open.
    assert len(bins) <= sum(r.length for r in out) / 64 + 15


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<html><body><nav>Menu</nav></body></html>", ""),
        (
            "<body><header>Top</header><article><h1>T&amp;t</h1><p>One <b>bold</b>\n text.<p>Of.<div class='ad'>Buy</div><p>Two&nbsp;.</article>"
            "<div id=comments><p>me too, a long comment that goes on and on and on</div><footer>&copy;</footer>",
            "T&t\nOne bold text.\nOf.\nTwo .",
        ),
        (
            "<body><div id='menu'><ul><li>a<li>b</ul></div><div class='story'><p>A long paragraph of real text stands here."
            "<p>Short.<p>Another long paragraph of real text stands here.</div><form>Name <input></form><script>x('<p>')</script>",
            "A long paragraph of real text stands here.\nShort.\nAnother long paragraph of real text stands here.",
        ),
    ],
)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("tail", ["<!-- x", "<![CDATA[ x", "<?php echo 1", "<!-- <p>x</p>"])
def test_open_marks_reach_to_the_end(tail):
    assert html_text.main_text(f"<article><p>{LONG}</p>{tail}") == LONG


LONG = "A long paragraph of real text stands here and goes on for a while."


@pytest.mark.parametrize(
    "body, text",
    [
        (f"<article><section><p>{LONG} One.</section><section><p>{LONG} Two.</section><div><p>Three.</div></article>", f"{LONG} One.\n{LONG} Two.\nThree."),
        (f"<article><h1>Title</h1><p>Lead</p><div class=body><p>{LONG}<p>{LONG}</div></article>", f"Title\nLead\n{LONG}\n{LONG}"),
        (f"<div class=story><h1>Title</h1><div><p>{LONG}<p>{LONG}</div></div>", f"Title\n{LONG}\n{LONG}"),
        (f"<article><p>{LONG}<p>{LONG}<blockquote>Last word</blockquote></article>", f"{LONG}\n{LONG}\nLast word"),
        (f"<article><table><tr><td>a<td>b</table><p>{LONG}<p>{LONG}</article>", f"a\nb\n{LONG}\n{LONG}"),
        (f"<table><tr><td>{LONG}<td>{LONG}</table>", f"{LONG}\n{LONG}"),
        (f"<article><p>{LONG}<p class='share-price'>Up by two.<p>{LONG}</article>", f"{LONG}\nUp by two.\n{LONG}"),
        (f"<article><p>{LONG}<table><tr><td class=social>a<td>b</table><p>{LONG}</article>", f"{LONG}\na\nb\n{LONG}"),
        (f"<article><p>{LONG}<h2 id=related>Related work</h2><p>{LONG}</article>", f"{LONG}\nRelated work\n{LONG}"),
        (f"<main><p>{LONG}<section id=discussion><h2>Discussion</h2><p>{LONG}</section></main>", f"{LONG}\nDiscussion\n{LONG}"),
        (f"<article><p>{LONG}<div class=related><a href=x>{LONG}</a> more</div><p>{LONG}</article>", f"{LONG}\n{LONG}"),
        (f"<article><p>{LONG}<div class=share>Tell others</div><div id=comments><p>{LONG}</div></article>", LONG),
        (f"<div class=story><p>{LONG}<p>{LONG}<div class=related><p>{LONG}</div></div>", f"{LONG}\n{LONG}"),
        (f"<article><p>{LONG}<?php echo '<p>' ?>b</article>", f"{LONG}b"),
        (f"<div>{LONG}</div><article><p>{LONG}<p>{LONG}</article><article><p>{LONG}</article>", f"{LONG}\n{LONG}\n{LONG}"),
    ],
)
def test_main_text_of_nested_containers(body, text):
    assert html_text.main_text(f"<body><nav>Menu</nav>{body}<footer>&copy;</footer>") == text


def test_tiling_equals_brute_force():
    rng = random.Random(9)
    for _ in range(60):
        item = [rng.choice("abcdefgh") + rng.choice("xyz") for _ in range(rng.randrange(5, 40))]
        cut = rng.randrange(len(item))
        text = [rng.choice("abcdefgh") + "q" for _ in range(10)] + item[cut:] + ["q"] * 3 + item[:cut]
        block = decontamination.TestBlock.of([(0, " ".join(item))])
        found = block.matches(" ".join(text))
        assert (found[0][1] if found else 0) == brute.tiles(text, item, decontamination.SEED)


def test_leaks(spark):
    item = "Which of the seven rivers, named in the old song, runs north before it meets the sea?"
    clean = " ".join(f"word{i}" for i in range(300))
    turned = "runs north before it meets the sea. And " + clean + " which of the seven rivers named in the old song"
    docs = docs_of(spark, [(1, f"{clean} {item.upper()} {clean}"), (2, turned), (3, clean), (4, None), (5, ""), (1, item), (None, item)])
    tests = spark.createDataFrame([(7, item), (8, None), (9, ""), (10, "too short"), (None, item)], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontamination.find_leaks(docs, tests).collect()} == {
        (d, i) for d in (1, 2, None) for i in (7, None)
    }
    kept = decontamination.drop_leaks(docs, tests)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5]
    assert decontamination.find_leaks(docs, tests.limit(0)).count() == 0


def test_leaks_of_short_items_and_of_scripts_without_spaces(spark):
    chinese = "\u6d4b\u8bd5\u6570\u636e\u4e0d\u5e94\u8be5\u51fa\u73b0\u5728\u8bad\u7ec3\u8bed\u6599\u4e2d"
    items = spark.createDataFrame([(1, "Who was he?"), (2, chinese), (3, "..."), (4, None)], "item_id long, text string")
    rows = [(1, "who was HE"), (2, "who was he then, and where did he go"), (3, f"abc {chinese}\u3002 def"), (4, chinese[:6]), (5, ""), (6, "!")]
    found = {(r.doc_id, r.item_id, r.coverage) for r in decontamination.find_leaks(docs_of(spark, rows), items).collect()}
    assert found == {(1, 1, 1.0), (3, 2, 1.0)}


def test_leaks_of_repeated_tokens_take_linear_time(monkeypatch):
    block = decontamination.TestBlock.of([("x", "no " * 60), ("y", "a b c d e f g")])
    began = time.process_time()
    assert block.matches("no " * 40_000) == [(0, 60, 1, 60)]
    assert time.process_time() - began < 8
    monkeypatch.setattr("spendmill.llm.decontamination._PAIRS_AT_ONCE", 3)
    assert block.matches("no " * 200 + "b c d e f") == [(0, 60, 1, 60), (1, 5, 1, 5)]


def test_blocks_cover_the_benchmark(spark):
    tests = spark.createDataFrame([(i, f"item number {i} has some words") for i in range(50)], "item_id long, text string")
    blocks = list(decontamination.test_blocks(tests, block_bytes=300))
    assert len(blocks) > 3
    assert sorted(i for block in blocks for i, _ in block) == list(range(50))


def test_line_dedup(spark):
    rng = random.Random(4)
    shared = [f"shared line {i} {rng.random()}" for i in range(30)]
    other = lambda d: [f"own line {d} {i}" for i in range(8)]
    rows = [(d, "\n".join([*other(d), *shared, *other(d + 100)])) for d in range(5)] + [(7, None), (8, ""), (9, "one"), (9, "one"), (None, "a\nb")]
    out = {r.doc_id: r.line_dedup_ for r in remove_repeated_lines(docs_of(spark, rows)).collect()}
    assert out[0].n_removed == 0 and out[0].text == rows[0][1]
    for d in range(1, 5):
        kept = out[d].text.split("\n")
        assert set(other(d)) <= set(kept) and len(kept) < 46 - 20
        assert out[d].n_removed == 46 - len(kept)
    assert out[7].text == out[8].text == "" and out[9].text == "one"
    assert remove_repeated_lines(docs_of(spark, [])).count() == 0


def test_repeated_line_blocks_are_found(spark):
    """Share of the lines of later copies that go, for blocks that stand in two texts between lines of their own."""
    rng = random.Random(11)
    line = lambda: f"{rng.getrandbits(60):x}"
    for size, share in ((6, 0.5), (10, 0.7), (20, 0.85), (40, 0.92)):
        rows, blocks = [], {}
        for k in range(60):
            blocks[k] = [line() for _ in range(size)]
            for copy in (0, 1):
                rows.append((2 * k + copy, "\n".join([*(line() for _ in range(15)), *blocks[k], *(line() for _ in range(15))])))
        out = {r.doc_id: r.line_dedup_ for r in remove_repeated_lines(docs_of(spark, rows)).collect()}
        assert all(out[2 * k].n_removed == 0 for k in blocks)
        for k, block in blocks.items():
            kept = out[2 * k + 1].text.split("\n")
            assert kept == [x for x in rows[2 * k + 1][1].split("\n") if x not in block or x in kept]
            assert len(kept) >= 30 and out[2 * k + 1].n_removed == 30 + size - len(kept)
        assert sum(out[2 * k + 1].n_removed for k in blocks) >= share * size * len(blocks)


def test_a_run_of_equal_lines_is_cut(spark):
    run = ["a", *["same"] * 181, "b"]
    rows = [(1, "\n".join(run)), (2, "\n".join(["c", "d", "e", *["same"] * 7, "f", "g"])), (2, None), (None, "\n".join(run))]
    out = {(r.doc_id, r.text): r.line_dedup_ for r in remove_repeated_lines(docs_of(spark, rows)).collect()}
    first, second, last = out[1, rows[0][1]], out[2, rows[1][1]], out[None, rows[3][1]]
    assert first.n_removed >= 170 and {"a", "same", "b"} == set(first.text.split("\n"))
    assert second.n_removed >= 4 and set("cdefg") <= set(second.text.split("\n"))
    assert last.n_removed == 183 and last.text == "" and out[2, None].text == ""


def test_licences(spark):
    rows = [
        (1, "x\nLicensed under the Apache License, Version 2.0."),
        (2, "All Rights RESERVED. all rights\nreserved"),
        (3, "GENERAL public-license"),
        (4, None),
        (5, "licensed apache under license the"),
        (6, "CC BY-NC 4.0 and licensed under CC BY-NC 4.0"),
    ]
    out = {r.doc_id: r for r in summarise(scan_licences(docs_of(spark, rows))).collect()}
    assert (out[1].labels, out[1].score, out[1].n_base) == ("apache-2.0", 1.0, 0)
    assert (out[2].n_base, out[2].first_word, out[2].last_word, out[2].base_labels) == (2, 0, 3, "reserved")
    assert out[3].base_labels == "gpl"
    assert (out[4].n_words, out[4].first_word, out[4].labels, out[4].score) == (0, None, "", 0.0)
    assert out[5].labels == ""
    assert out[6].labels == "cc-by,cc-by-nc-4.0" and out[6].n_base == 2
    assert summarise(scan_licences(docs_of(spark, []))).count() == 0


def test_licences_of_a_text_with_all_statements(spark):
    words = " ".join(sorted({w for t in TEMPLATES.values() for w in t.words} - {"mit"}))
    rows = [(1, "\n".join(f"x {t.text} y" for t in TEMPLATES.values())), (2, f"{words} x released under the MIT license")]
    rows += [(10 + i, "the mit license version by 4 0 general public software") for i in range(20)]
    out = {r.doc_id: r for r in summarise(scan_licences(docs_of(spark, rows))).collect()}
    assert set(out[1].labels.split(",")) >= set(TEMPLATES) and out[1].score == 1.0
    assert out[1].n_found == sum(
        " ".join(rows[0][1].split()).count(f" {t.key} ") for t in TEMPLATES.values()
    )
    assert "mit" in out[2].labels.split(",") and out[2].n_found == 1 and out[2].score == 1.0


@pytest.mark.parametrize("n, k, alpha", [(10, 0, 0.02), (400, 3, 0.02), (400, 8, 0.02), (50_000, 900, 0.02), (100, 50, 0.02), (30, 1, 0.1)])
def test_binomial_tail(spark, n, k, alpha):
    from math import comb

    tail = spark.range(1).select(quality_rules.binomial_tail(f"{n}L", f"{k}L", alpha)).first()[0]
    if k >= n * alpha:
        assert tail == 1.0
    else:
        from math import exp, lgamma, log

        exact = sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * log(alpha) + (n - i) * log(1 - alpha)) for i in range(k + 1))
        assert tail == pytest.approx(exact, rel=1e-6)
        assert comb(n, 0) == 1


def test_quality_rules(spark):
    good = " ".join(f"plain{i}" for i in range(60))
    junk = " ".join(f"ju{i}%%%" for i in range(60))
    rows = [(i, good.replace("plain", f"p{i}x")) for i in range(900)] + [(1000, junk), (1001, None), (1002, ""), (1003, "a b " * 60)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(900)] + [(1000, 0, 0), (None, 1, 0), (3, None, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in quality_rules.score_documents(docs_of(spark, rows), labels).collect()}
    assert all(out[i].kept for i in range(900))
    assert not out[1000].base_failed and not out[1000].kept
    assert out[1001].base_failed and out[1002].n_words == 0 and out[1003].base_failed
    assert out[1003].n_repeat_words == 120
    # Without labels nothing is certified, so only the base rule rejects.
    bare = {r.doc_id: r.kept for r in quality_rules.score_documents(docs_of(spark, rows), labels.limit(0)).collect()}
    assert bare[1000] and not bare[1001]
    kept = quality_rules.keep_documents(docs_of(spark, rows), labels)
    assert kept.count() == 900 and kept.columns == docs_of(spark, rows).columns
    assert quality_rules.score_documents(docs_of(spark, []), labels).count() == 0


def test_repeated_rows_and_copies_are_one_trial(spark):
    """One document listed often, and copies of its text, prove nothing."""
    good = " ".join(f"plain{i}" for i in range(60))
    labels = spark.createDataFrame([(i, 1) for i in range(500)], "doc_id long, quality int")
    for rows in ([(1, good)] * 1500, [(i, good) for i in range(500)] * 3):
        cutoffs = quality_rules.certified_cutoffs(quality_rules.features(docs_of(spark, rows)), labels)
        assert cutoffs.count() == 0


def test_quality_of_a_very_long_text(spark):
    rows = [(1, "word other " * 50_000), (2, " ".join(f"w{i}" for i in range(60_000)))]
    labels = spark.createDataFrame([], "doc_id long, quality int")
    out = {r.doc_id: (r.n_words, r.n_repeat_words, r.kept) for r in quality_rules.score_documents(docs_of(spark, rows), labels).collect()}
    assert out == {1: (100_000, 100_000, False), 2: (60_000, 0, True)}


@pytest.mark.parametrize(
    "page, text",
    [
        ("<p>text<![x[ foo ]]></p><p>more of the text</p>", "more of the text"),
        ("<p>some words</p><![if gte mso 9]><p>then others</p><![endif]>", "then others"),
        ("<p>first words</p><!x[ <p>last words</p>", "first words"),
    ],
)
def test_malformed_sections_do_not_stop_a_page(page, text):
    assert text in html_text.main_text(page)


def test_any_marks_are_read():
    rng = random.Random(6)
    parts = ["<p>", "</p>", "<![", "<!", "]]>", "<?php", "?>", "<!--", "-->", "<![CDATA[", "x[", ">", "<", "&", "&#x;", "words here ", "<a b='", "'", "</", "<td", "<script>", "</script>"]
    for _ in range(3000):
        html_text.main_text("".join(rng.choice(parts) for _ in range(rng.randrange(1, 25))))


def test_stray_marks_take_linear_time():
    import time

    began = time.process_time()
    html_text.main_text("<span>" * 50_000 + "<hr>" * 50_000 + "<div>" * 30_000 + "</h1>" * 50_000 + "words")
    assert time.process_time() - began < 20


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), SF_DIR, ORACLES[name]) == []


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF_DIR)
        assert after.columns == docs.columns and after.dtypes == docs.dtypes
        after = corpus_pipeline.Workspace(spark, "test").write(after, name)
        texts[name] = {r.doc_id: r.text for r in after.collect()}
        assert 0 < len(texts[name]) <= docs.count()
        docs = after
    # Of each component of what the line stage kept, the smallest id stays; then of each group of near copies.
    before = texts["lines"]
    prints = [(doc, brute.simhash(text, 5)) for doc, text in before.items()]
    first = set(brute.components(prints).values())
    assert set(texts["near_duplicates"]) == set(brute.near_copies([(d, t) for d, t in before.items() if d in first], 5))
    packed = corpus_pipeline.run(spark, SF_DIR)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(texts["decontamination"])
    assert packed.agg(F.max("length")).first()[0] <= 2048
