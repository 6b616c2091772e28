"""Source divergence, token alignment and byte-level encoding against plain versions, the libraries, and odd inputs."""

import base64
import cProfile
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from public_tokenizers import PATTERN, path
from pyspark.sql import functions as F

from spendmill.llm import byte_bpe, source_divergence, token_alignment
from spendmill.llm.oracles import ORACLES
from spendmill.llm.queries import QUERIES
from spendmill.verify.compare import differences
from tests.llm.test_corpus import SCHEMA, SF_DIR, docs_of, odd_rows

RANKS, A_FILE, B_FILE = path("byte_bpe_50k.tiktoken"), path("byte_bpe_50k.json"), path("piece_bpe_32k.model")


def texts_for_tokenizers():
    rng = random.Random(8)
    rows = odd_rows()
    pool = ["word", " the", "  ", "\n", "\n\n", "\t", "don't", "we'll", "'", "'re", "…", "é", "日本語", "😀", "123", "4", "!?", " ", "\r\n", "İK", "\x00", "\x85"]
    rows += [(100 + i, "".join(rng.choice(pool) for _ in range(rng.randrange(1, 200)))) for i in range(40)]
    rows += [(200, "<|endoftext|> and <s> </s> <unk> <0x41>"), (201, "a▁b"), (202, " " * 300), (203, "x" * 700), (203, "x" * 700)]
    rows += [(204, "\n" * 130 + "end"), (205, "é" * 90), (2**60 + 1, "big id"), (206, "ab " * 2000 + "y" * 400 + " z" * 50)]
    return rows


# Byte-level encoding.


def library():
    import tiktoken

    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def coded(df):
    rows = byte_bpe.decode_ids(df, RANKS).select("doc_id", "ids", "decoded").collect()
    return sorted(((r.doc_id, np.frombuffer(bytes(r.ids), "<u4").tolist(), bytes(r.decoded).decode()) for r in rows), key=repr)


@pytest.mark.parametrize("chunk, overlap", [(10**9, 1), (64, 16), (40, 40), (50, 1)])
def test_encoding_equals_the_library(spark, chunk, overlap):
    rows = texts_for_tokenizers()
    own = library()
    expected = sorted(((d, own.encode_ordinary(t or ""), t or "") for d, t in rows), key=repr)
    assert coded(byte_bpe.encode_texts(docs_of(spark, rows), RANKS, chunk, overlap)) == expected


def test_encoding_of_an_empty_table_and_types(spark):
    assert coded(byte_bpe.encode_texts(docs_of(spark, []), RANKS)) == []
    with pytest.raises(ValueError):
        byte_bpe.encode_texts(docs_of(spark, []), RANKS, 10, 11)


def test_decoding_of_cut_ids(spark):
    """Half a character decodes to its bytes, and null to null; a column of the result's name stays."""
    ids = np.array(library().encode_ordinary("😀")[:1], "<u4").tobytes()
    rows = spark.createDataFrame([(1, ids, "own"), (2, None, "own")], "doc_id long, ids binary, decoded string")
    got = {r.doc_id: (r.decoded, r.decoded_) for r in byte_bpe.decode_ids(rows, RANKS).collect()}
    assert got[1][0] == "own" and "😀".encode().startswith(bytes(got[1][1])) and got[2] == ("own", None)


def test_a_full_memo_changes_nothing(monkeypatch):
    monkeypatch.setattr(byte_bpe, "MEMO_WORDS", 2)
    encoder, text = byte_bpe.RankEncoder(RANKS), "one two three two one four" * 5
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library().encode_ordinary(text)


def test_a_long_word_does_not_take_quadratic_time():
    text = "ab" * 100_000
    assert len(byte_bpe.encoder_for(RANKS).encode(text)) // 4 == len(library().encode_ordinary(text))


def test_byte_bpe_query(spark):
    own = library()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    expected = []
    for doc, text in docs:
        ids = own.encode_ordinary(text or "")
        digests = [hashlib.sha256(data).hexdigest() for data in (np.array(ids, "<u4").tobytes(), (text or "").encode())]
        expected.append((doc, len(ids), *digests))
    got = QUERIES["op13_byte_bpe"](spark, SF_DIR).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted(map(tuple, got.collect())) == sorted(expected)


# Alignment.


def plain_alignment(rows):
    """Byte by byte, with the libraries' own tokens."""
    loaded = token_alignment.Tokenizers(A_FILE, B_FILE)
    documents, counts = [], Counter()
    for doc, text in rows:
        data = (" " + (text or "")).encode()
        a = loaded.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = loaded.b.encode(text) if text else []
        if b"".join(loaded.a_bytes[i] for i in a) != data or b"".join(loaded.b_bytes[i] for i in b) != data:
            a, b = [], []
        owner_a = [n for n, i in enumerate(a) for _ in loaded.a_bytes[i]]
        owner_b = [n for n, i in enumerate(b) for _ in loaded.b_bytes[i]]
        links = sorted(set(zip(owner_a, owner_b)))
        groups, last = [], (-1, -1)
        for at in range(len(owner_a)):
            end = at + 1 == len(owner_a)
            if end or (owner_a[at] != owner_a[at + 1] and owner_b[at] != owner_b[at + 1]):
                ids = [",".join(str(x[n]) for n in range(p + 1, owner[at] + 1)) for x, p, owner in ((a, last[0], owner_a), (b, last[1], owner_b))]
                groups.append("|".join(ids))
                last = (owner_a[at], owner_b[at])
        pairs = [(a[x], b[y]) for x, y in links]
        counts.update(pairs)
        documents.append((doc, len(a), len(b), groups, pairs))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return sorted(
        (
            (d, n_a, n_b, len(groups), len(pairs), sum(counts[p] == best[p[1]] for p in pairs), sum(counts[p] for p in pairs), ";".join(groups))
            for d, n_a, n_b, groups, pairs in documents
        ),
        key=repr,
    )


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


@pytest.mark.parametrize("batch_chars", [1, 500, 10**6])
def test_alignment_equals_the_plain_version(spark, batch_chars):
    rows = texts_for_tokenizers()
    out = token_alignment.count_links(token_alignment.align_tokens(docs_of(spark, rows), A_FILE, B_FILE, batch_chars))
    assert sorted(map(tuple, out.select(*COLUMNS).collect()), key=repr) == plain_alignment(rows)


@pytest.mark.parametrize("rows", [[], [(1, None), (2, ""), (None, None), (3, "a▁b")]], ids=["empty", "no tokens"])
def test_alignment_without_tokens(spark, rows):
    out = token_alignment.count_links(token_alignment.align_tokens(docs_of(spark, rows), A_FILE, B_FILE))
    assert sorted(map(tuple, out.select(*COLUMNS).collect()), key=repr) == sorted(((d, 0, 0, 0, 0, 0, 0, "") for d, _ in rows), key=repr)


@pytest.mark.parametrize("steps", [1, 2, 3, 7, 64, 10**6])
def test_shares_of_the_merge_path(steps):
    """Any share gives the same overlaps, ends that meet across a border included."""
    rng = random.Random(steps)
    for _ in range(50):
        stop = rng.randrange(1, 60)
        a, b = (np.array(sorted({stop, *(rng.randrange(1, stop + 1) for _ in range(rng.randrange(30)))})) for _ in "ab")
        a_at, b_at, shared = token_alignment.overlaps(a, b, steps)
        cuts = sorted({*a.tolist(), *b.tolist()})
        expected = [(np.searchsorted(a, c), np.searchsorted(b, c), c in a and c in b) for c in cuts]
        assert list(zip(a_at, b_at, shared)) == expected
        a_border, b_border = token_alignment.path_borders(a, b, steps)
        work = np.diff(a_border) + np.diff(b_border)
        assert (work[:-1] == steps).all() and work.sum() == len(a) + len(b)


def test_words_encode_like_whole_texts(monkeypatch):
    """Word by word with a memo, a full one included, as the library encodes the text."""
    loaded = token_alignment.Tokenizers(A_FILE, B_FILE)
    texts = [" " + (text or "") for _, text in texts_for_tokenizers()] + [f" {chr(c)}a{chr(c)} {chr(c)}1" for c in range(1, 0x2FFF, 3) if not 0xD800 <= c < 0xE000]
    expected = [e.ids for e in loaded.a.encode_batch_fast(texts, add_special_tokens=False)]
    assert loaded._encode_a(texts) == expected
    monkeypatch.setattr(token_alignment, "MEMO_WORDS", 5)
    assert [loaded._encode_a([text])[0] for text in texts] == expected


def test_alignment_calls_no_function_per_token():
    """Tokens of known words are gathered by arrays; only the library handles single tokens."""
    rng = random.Random(3)
    texts = [" ".join(f"word{rng.randrange(50)}" for _ in range(400)) for _ in range(20)]
    loaded = token_alignment.Tokenizers(A_FILE, B_FILE)
    token_alignment._align_batch(loaded, texts, 0)
    profile = cProfile.Profile()
    columns = profile.runcall(token_alignment._align_batch, loaded, texts, 0)
    tokens = sum(columns[1].to_pylist()) + sum(columns[2].to_pylist())
    assert sum(entry.callcount for entry in profile.getstats()) < tokens / 5


def test_words_that_do_not_give_their_bytes_back():
    """Their texts have no tokens, others keep theirs, in any order and when the words are known already."""
    loaded = token_alignment.Tokenizers(A_FILE, B_FILE)
    expected = loaded.a.encode(" good text", add_special_tokens=False).ids
    for i in loaded.a.encode(" strange", add_special_tokens=False).ids:
        loaded.a_bytes[i] = b"?"
    for _ in range(2):
        (a, n_a), (b, n_b) = loaded.encode(["good text", "a strange text", "", "good text"])
        assert a.tolist() == expected * 2 and n_a.tolist() == [len(expected), 0, 0, len(expected)]
        assert b.tolist() == loaded.b.encode("good text") * 2 and n_b.tolist() == [len(b) // 2, 0, 0, len(b) // 2]


def test_alignment_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op12_token_alignment"](spark, SF_DIR).select(*COLUMNS[:-1], "groups_sha256")
    digest = lambda groups: hashlib.sha256(groups.encode()).hexdigest() if groups else ""
    assert sorted(map(tuple, got.collect())) == [(*row[:-1], digest(row[-1])) for row in sorted(plain_alignment(docs))]


# Source divergence.


def plain_divergence(rows, least, top):
    """Dense: every kept term of every source."""
    import re

    word = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = {c: c + 32 for c in range(65, 91)}
    counts, documents, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        terms = [t.translate(lower) for t in word.findall(text or "")]
        group = (lang or "", source or "")
        groups.add(group)
        counts[group].update(terms)
        documents[group[0]].update(set(terms))
    out = []
    for lang, source in groups:
        kept = [t for t, n in documents[lang].items() if n >= least]

        def level(of, total):
            return {t: 1 + 10**9 * (of[t] + 5) // (total + 5 * len(kept)) for t in kept}

        members = sorted(s for g, s in groups if g == lang)
        per = {s: level(counts[lang, s], sum(counts[lang, s][t] for t in kept)) for s in members}
        whole = sum((counts[lang, s] for s in members), Counter())
        q = level(whole, sum(whole[t] for t in kept))
        own = per[source]
        pairs = [(sum(abs(own[t] - per[s][t]) for t in kept), s) for s in members if s != source]
        above = [(own[t] - q[t], t) for t in kept if counts[lang, source][t] and own[t] > q[t]]
        for part, items, limit in (("pair", pairs, None), ("term", above, top)):
            items.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, item, value, n) for n, (value, item) in enumerate(items[:limit], 1)]
    return sorted(out)


def divergence_rows():
    rng = random.Random(3)
    words = [f"{a}{b}" for a in "abcdeé" for b in "xyzÉß日"] + ["Kelvin", "STOP", "don't", "a1b"]
    rows = [
        (" ".join(rng.choice(words[: 10 + 6 * (i % 5)]) for _ in range(rng.randrange(1, 30))), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", "S3", None]))
        for i in range(260)
    ]
    # One text in many copies, over several sources; sources without terms; a language without kept terms; empty names.
    rows += [("Common text, common words", "en", f"s{i % 3}") for i in range(90)]
    rows += [(None, "en", "silent"), ("", "en", "silent2"), ("12 34", "de", "numbers"), ("rare words", "fr", "a"), ("", "fr", "b"), ("x", "", "")]
    return rows + [("Kelvin " * 5000, "en", "s1")]


def divergence_docs(spark, rows):
    full = [(i, t, lang, s, 0, *["x"] * 8) for i, (t, lang, s) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).withColumns({"k2": F.lit(1), "copies": F.lit("x"), "rank": F.lit("y")})


@pytest.mark.parametrize("held", [source_divergence.HELD_TERMS, 3])
def test_divergence_equals_the_dense_version(spark, monkeypatch, held):
    rows = divergence_rows()
    monkeypatch.setattr(source_divergence, "HELD_TERMS", held)
    got = source_divergence.audit_sources(divergence_docs(spark, rows))
    assert sorted(map(tuple, got.collect())) == plain_divergence(rows, 30, 50)


def test_divergence_of_an_empty_table(spark):
    assert source_divergence.audit_sources(divergence_docs(spark, [])).collect() == []


def test_huge_counts_stay_exact(spark):
    """Products beyond 64 bits."""
    rows = spark.createDataFrame([(9 * 10**17, 9 * 10**17 + 7, 3)], "n long, total long, terms long")
    got = rows.select(source_divergence._smoothed(F.col("n"), F.col("total"), F.col("terms")).alias("p")).first().p
    assert got == 1 + 10**9 * (9 * 10**17 + 5) // (9 * 10**17 + 22)


def test_divergence_query(spark):
    assert differences(QUERIES["op11_source_divergence"](spark, SF_DIR), SF_DIR, ORACLES["op11_source_divergence"]) == []
