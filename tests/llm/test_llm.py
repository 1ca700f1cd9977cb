"""The corpus operators against brute force, and their defined cases."""

import collections
import datetime
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strandline.llm import _components, _text, _tokens, decontamination, fingerprints, line_dedup, lm_scoring, near_dedup, packing, quality_classifier, sharding, token_counts, url_filters

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
UPPER = {v: k for k, v in LOWER.items()}
RNG = random.Random(3)
VOCABULARY = ["".join(RNG.choice("abcdefghijéß") for _ in range(RNG.randint(1, 9))) for _ in range(400)]


def prose(n):
    return " ".join(RNG.choice(VOCABULARY) for _ in range(n))


BASE, PASSAGE = prose(120), prose(14)
LINE = "This very line stands in several documents"
EDITED = BASE.split()
EDITED[40] = "changed"
TEXTS = {
    0: BASE, 1: BASE, 2: " ".join(EDITED), 3: "before " + PASSAGE.translate(UPPER) + ", after", 4: None, 5: "", 6: "...!!!", 7: "...!!!",
    8: f"{LINE}\nown one\n  {LINE.upper()} ", 9: f"x\n{LINE}\n", 10: f"{LINE}\n" + prose(30), 11: prose(9000), 12: prose(3), 13: "日本語 <|endoftext|> ʰ text", 14: prose(60), 15: "\n\n",
}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


@pytest.fixture(scope="module")
def docs(spark):
    """Rows of every defined case, with columns named like those that the operators make."""
    rows = [(i, t, "en", "a", len(t or ""), "clash", 1) for i, t in TEXTS.items()] + [(14, TEXTS[14], "en", "a", 0, "again", 2), (None, prose(20), None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, shard string, n_words int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(7, PASSAGE), (70, PASSAGE), (8, "nowhere to be found at all"), (9, None), (10, TEXTS[12]), (None, TEXTS[14][:50])], "item_id long, text string")


def empty(df):
    return df.filter("false")


def test_words_and_hashes():
    texts = ["Ab c1-é", "", "x", "Ab", "_", "é" * 5]
    w = _text.words(*_text.strings(pa.array(texts)))
    got = [[w.word(i).decode() for i in range(w.per_text[k], w.per_text[k + 1])] for k in range(len(texts))]
    assert got == [words(t) for t in texts]
    h = w.hashes()
    assert h[0] == h[w.per_text[3]] and len(set(h.tolist())) == len({x for g in got for x in g})


def test_leaks(docs, benchmark):
    got = decontamination.leak_report(docs, benchmark).collect()
    items = [(r.item_id, words(r.text)) for r in benchmark.collect()]
    assert len(got) == docs.count()
    source = collections.defaultdict(list)
    for r in docs.collect():
        source[r.doc_id].append(r.text)
    for r in got:
        w = words(source[r.doc_id][0])
        hit, found = set(), set()
        for item, iw in items:
            k = min(10, len(iw))
            wins = {tuple(iw[i : i + k]) for i in range(len(iw) - k + 1)} if k else set()
            at = [i for i in range(len(w) - k + 1) if k and tuple(w[i : i + k]) in wins]
            hit |= {j for i in at for j in range(i, i + k)}
            found |= {str(item)} if at and item is not None else set()
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (len(w), len(hit), len(found), bool(hit))
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


def test_leaks_in_blocks_and_removal(docs, benchmark):
    whole = sorted(map(str, decontamination.find_leaks(docs, benchmark).select("doc_id", "hit_spans", "hit_items").collect()))
    blocks = sorted(map(str, decontamination.find_leaks(docs, benchmark, most_bytes=200).select("doc_id", "hit_spans", "hit_items").collect()))
    assert whole == blocks
    kept = decontamination.drop_leaking_documents(docs, benchmark)
    assert kept.columns == docs.columns and {3, 12} & {r.doc_id for r in kept.collect()} == set()
    cut = decontamination.cut_leaking_spans(docs, benchmark)
    assert {r.doc_id: r.text for r in cut.collect()}[3] == "before , after" and cut.count() == docs.count()
    assert decontamination.leak_report(empty(docs), benchmark).count() == 0
    assert decontamination.leak_report(docs, empty(benchmark)).filter("contaminated").count() == 0


def brute_lines(rows, least=3, size=20):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = collections.defaultdict(set)
    for d, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= size:
                holders[key(x)].add(d)
    lost = {k: max(v) for k, v in holders.items() if len(v) >= least}
    out = {}
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if lost.get(key(x), d) == d]
        out[d] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


@pytest.mark.parametrize("batches", [1, 4])
def test_lines(spark, docs, batches):
    rows = [(i, t) for i, t in TEXTS.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.row.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in line_dedup.dedup_lines(df, batches=batches).collect()}
    assert got == brute_lines(rows) and sum(x[1] for x in got.values()) == 3
    out = line_dedup.without_repeated_lines(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert {r.doc_id: r.n_chars for r in out.collect()}[9] == 2
    assert line_dedup.line_report(empty(docs)).count() == 0


def test_line_runs_compact(spark, tmp_path):
    runs = line_dedup.LineRuns(spark, f"file://{tmp_path}", 4)
    for b in range(5):
        runs.add(spark.range(b, b + 10).select((F.col("id") % 12).alias("h1"), F.lit(0).cast("long").alias("h2"), F.lit(1).cast("long").alias("n_docs"), F.lit(100 - b).cast("long").alias("keeper")))
    assert sum(map(len, runs.levels.values())) == 2
    got = {r.h1: (r.n_docs, r.keeper) for r in runs.merged().collect()}
    want = collections.Counter(i % 12 for b in range(5) for i in range(b, b + 10))
    assert {k: v[0] for k, v in got.items()} == want
    assert got[0][1] == 100 and got[10][1] == 99
    runs.drop()


def test_long_and_odd_lines(spark):
    """Very many lines, lines of a document more than once, null and repeated ids: against brute force by rows."""
    many = [f"line number {i % 700} of the document" for i in range(20_000)]
    rows = [(1, "\n".join(many)), (2, "\n".join(many[:900])), (3, "\n".join(reversed(many))), (4, "\n".join([LINE, LINE, "own"])), (5, LINE), (6, LINE + "\n"), (None, LINE), (6, "x\n" + LINE), (7, None), (8, "y" * 300_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.row.doc_id if r.row.doc_id is not None else -1, r.row.text or "", r.n_lines, r.n_dropped, r.kept) for r in line_dedup.dedup_lines(df).collect())
    want = []
    for i, (d, t) in enumerate(rows):
        own = brute_lines([(-1 if d is None else d + i / 100, t) for i, (d, t) in enumerate(rows)])[-1 if d is None else d + i / 100]
        if d == 6:  # both rows have the largest id of the line
            own = (len(t.split("\n")), 0, t)
        want.append((-1 if d is None else d, t or "", *own))
    assert got == sorted(want)


def test_the_anti_join_decides(spark, tmp_path):
    """A key is in one run only, that of the first batch to hold it, whatever later batches say."""
    runs = line_dedup.LineRuns(spark, f"file://{tmp_path}", 2)
    batch = lambda rows: spark.createDataFrame(rows, "h1 long, h2 long, n_docs long, keeper long")
    runs.add(batch([(1, 1, 2, 50), (2, 2, 1, 40)]))
    runs.add(batch([(1, 1, 1, 99), (3, 3, 1, 98)]))
    runs.add(batch([(3, 3, 4, 1), (2, 2, 1, 100)]))
    held = [r.h1 for name in runs.runs.names for r in spark.table(name).collect()]
    assert sorted(held) == [1, 2, 3]
    assert {r.h1: (r.n_docs, r.keeper) for r in runs.merged().collect()} == {1: (3, 50), 2: (2, 40), 3: (5, 98)}
    runs.drop()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("lines_")]


def test_packing(docs):
    path = _tokens.tokenizer_path()
    got = packing.packing_report(docs).collect()
    encode = lambda t: [*_tokens.tokenizer(path).encode(t or "", add_special_tokens=False).ids, 2]
    want = collections.Counter()
    for r in docs.collect():
        own = encode(r.text)
        for k, (start, n) in enumerate(packing.cut(len(own), 1024)):
            want[r.doc_id, k, start, n, zlib.crc32(np.array(own[start : start + n], "<u4").tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 1024
    assert len(sequences) <= sum(r.length for r in got) / 1024 + 2
    assert packing.packing_report(empty(docs)).count() == 0


def test_best_fit_closes_the_fullest():
    bins, offsets = packing.best_fit([6, 5, 4, 5, 3], 10, 2)
    assert (bins, offsets) == ([0, 1, 0, 1, 2], [0, 0, 6, 5, 0])
    assert packing.best_fit([7, 6, 4, 3], 10, 1)[0] == [0, 1, 1, 2]
    sizes = [RNG.randint(1, 1024) for _ in range(20_000)]
    assert (max(packing.best_fit(sizes, 1024, 8192)[0]) + 1) / (sum(sizes) / 1024) < 1.02


def test_tokens(docs):
    path = _tokens.tokenizer_path()
    t = _tokens.tokenizer(path)
    got = collections.Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_report(docs).collect())
    want = collections.Counter()
    for r in docs.collect():
        n = len(t.encode(r.text or "", add_special_tokens=False).ids)
        want[r.doc_id, len((r.text or "").encode()), n, n > 1024] += 1
    assert got == want
    for text in [TEXTS[11], "a b " * 900, "x" * 999, "it's 12 a  b\n c<|endoftext|> d e"]:
        ids = t.encode(text, add_special_tokens=False).ids
        assert _tokens.ids(text, path).tolist() == ids
    assert token_counts.token_report(empty(docs)).count() == 0
    assert token_counts.token_report(docs).columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert token_counts.count_tokens(docs, path).count() == docs.count()
    model = _tokens.tokenizer_path("piece_bpe_32k.model")
    assert token_counts.count(["a b", None], model).tolist() == [len(_tokens.sentencepiece(model).encode("a b")), 0]


def test_units_have_the_ids_of_whole_texts(monkeypatch):
    """White space of every kind, marks, contractions, special strings and long texts without spaces, against the libraries."""
    path, model = _tokens.tokenizer_path(), _tokens.tokenizer_path("piece_bpe_32k.model")
    t, sp = _tokens.tokenizer(path), _tokens.sentencepiece(model)
    letters = [" "] * 6 + ["  ", "\n", "\t", "\r", "\xa0", "　", "\x0b", "\x1c", "\x85", "\u2028", "́", "‍"] + list("abcZé日本。，عж1２٣!.,'-_<|>▁") + ["'s", "'ll", "<|endoftext|>", "word", "👍"]
    texts = ["".join(RNG.choice(letters) for _ in range(RNG.randint(0, 14))) for _ in range(4000)]
    want = [t.encode(x, add_special_tokens=False).ids for x in texts]
    assert [_tokens.ids(x, path).tolist() for x in texts] == want
    assert [len(x) >> 2 for x in _tokens.encoded(pa.array(texts), path, 100)] == [len(x) for x in want]
    monkeypatch.setattr(_tokens, "PART", 5)
    monkeypatch.setattr(_tokens, "MOST_UNITS", 40)
    own = _tokens.Encoder(path)
    for k in range(0, len(texts), 50):
        assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts[k : k + 50])] == want[k : k + 50]
    long_ = "日本、語。語！" * 50
    assert np.frombuffer(own.encode([long_])[0], "<u4").tolist() == t.encode(long_, add_special_tokens=False).ids
    assert [np.frombuffer(x, "<u4").tolist() for x in _tokens.Encoder(model).encode(texts)] == sp.encode(texts)
    other = _tokens.tokenizer_path("word_bpe_49k.json")
    assert not _tokens.cuttable(other) and _tokens.ids("Two Words", other).tolist() == _tokens.tokenizer(other).encode("Two Words", add_special_tokens=False).ids


def test_texts_with_runs_of_white_space_are_cut():
    """Indented code, tables, trailing blanks and runs of spaces: many short units, the library's ids."""
    path = _tokens.tokenizer_path()
    t, own = _tokens.tokenizer(path), _tokens.Encoder(path)
    code = "".join(f"{' ' * RNG.randint(0, 12)}if x{i} == {i}:   \n{' ' * 8}return  f( a,\t b )  \n \n" for i in range(3000))
    rows = "".join(f"{i:<9}|   {i * 7:>12} |\t \n" for i in range(3000))
    for text in (code, rows, "word " * 30_000 + "   and " + "word " * 30_000, "a \n \nb" * 2000, "  <|endoftext|>  x <|endoftext|>   " * 500, " " * 3000 + "end", "end" + " " * 3000):
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == t.encode(text, add_special_tokens=False).ids
    for text in (code, rows, "word " * 30_000 + "   and " + "word " * 30_000):
        assert max(map(len, own.units(text))) < 60 and len(own.units(text)) > 3000


def word_similarity(a, b):
    """1 - edit distance / length of the longer, by the whole table."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return 1 - row[-1] / max(len(a), len(b)) if a or b else 1.0


def brute_groups(rows, same):
    parent = {k: k for k, _ in rows}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, (a, x) in enumerate(rows):
        for b, y in rows[:i]:
            if same(x, y):
                parent[find(a)] = find(b)
    groups = collections.defaultdict(list)
    for k in parent:
        groups[find(k)].append(k)
    return {k: min(g) for g in groups.values() for k in g}


def near_rows(n=40):
    rows, base = [], prose(90).split()
    for i in range(n):
        own = list(base)
        for _ in range(RNG.randint(0, 6)):
            own[RNG.randrange(len(own))] = RNG.choice(VOCABULARY)
        rows.append((i, " ".join(own)))
    return rows + [(n + i, prose(RNG.randint(1, 60))) for i in range(20)] + [(100, "..."), (101, "..."), (102, None), (103, ""), (104, rows[0][1].translate(UPPER))]


@pytest.mark.parametrize(("block", "few"), [(1024, 4096), (7, 4096), (7, 0)])
def test_near_groups(spark, monkeypatch, block, few):
    """few 0 has large buckets go by the prefix filter, else their askers are broadcast."""
    monkeypatch.setattr(near_dedup, "FEW", few)
    rows = near_rows()

    def same(x, y):
        a, b = words(x), words(y)
        return word_similarity(a, b) >= 0.8 - 1e-9 if a and b else not a and not b and (x or "") == (y or "")

    want = brute_groups(rows, same)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_dedup.near_groups(df, block=block).collect()
    by_root = collections.defaultdict(list)
    for r in found:
        by_root[bytes(r.root)].append(r.doc_id)
    assert {d: min(g) for g in by_root.values() for d in g} == want


def test_near_report(docs):
    got = near_dedup.near_report(docs).collect()
    classes = {r.doc_id: r.class_id for r in got}
    assert classes[0] == classes[1] == classes[2] == 0 and classes[6] == classes[7] == 6 and classes[4] == classes[5] == 4
    assert len(got) == docs.count() and classes[8] == 8 and classes[None] is None
    kept = near_dedup.one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [0, 3, 4, 6, 8, 9, 10, 11, 12, 13, 14, 15]
    assert near_dedup.near_report(empty(docs)).count() == 0


def test_distances_match_the_table():
    """Edited, rotated, repeated and unrelated sequences, at every bound."""
    for k in range(400):
        a = [RNG.randint(0, 3 if k % 3 else 60) for _ in range(RNG.randint(1, 40))]
        b = [x if RNG.random() > 0.08 else RNG.randint(0, 60) for x in a if RNG.random() > 0.05] or [1]
        if k % 4 == 0:
            c = RNG.randrange(len(b))
            b = b[c:] + b[:c]
        x, y = np.array(a, "<u4"), np.array(b, "<u4")
        d = round((1 - word_similarity(a, b)) * max(len(a), len(b)))
        assert [near_dedup.distance_within(x, y, m) for m in range(0, 45)] == [m >= d for m in range(0, 45)]
        assert min(len(a), len(b)) < near_dedup.ANCHOR or near_dedup._anchored(x, y) >= d
        assert all(min(near_dedup._banded(x, y, m), m + 1) == min(d, m + 1) for m in (1, 4, 9, 45) if abs(len(a) - len(b)) <= m)


def test_prefixes_of_similar_texts_meet():
    for k in range(400):
        a = [RNG.randint(0, 200 if k % 2 else 4) for _ in range(RNG.randint(5, 60))]
        b = list(a)
        for _ in range(near_dedup.edits(len(a), len(a), 0.8)):
            at = RNG.randrange(len(b))
            b[at : at + RNG.choice([1, 1, 0])] = [RNG.randint(0, 200)] * RNG.choice([1, 1, 0])
        if word_similarity(a, b) < 0.8 - 1e-9:
            continue
        s, at = near_dedup.labelled([np.array(v, "<u4").tobytes() for v in (a, b)], 2)
        n = np.diff(at)
        text = np.repeat([0, 1], n)
        first = near_dedup.prefixes(text, np.array([hash((int(x), 5)) % 9 for x in s]), s, n, 0.8)
        assert set(s[first & (text == 0)].tolist()) & set(s[first & (text == 1)].tolist())


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 102), (102, 101), (200, 200)]
    got = {r.node: r.root for r in _components.components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {**dict.fromkeys(range(51), 0), 100: 100, 101: 100, 102: 100}


def test_fingerprints(spark):
    rows = [(i, t) for i, t in TEXTS.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in fingerprints.fingerprint_report(df, samples=48, partition_bytes=10_000).collect()}
    ids = sorted(TEXTS)
    errors = []
    for i, d in enumerate(ids):
        t, n = TEXTS[d] or "", TEXTS[ids[(i + 1) % len(ids)]] or ""
        half = len(t) // 2
        e = t[: len(t) - half] + n[:half]
        assert got[d].n_chars == len(t) and got[d].edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        a, b, c = (collections.Counter(words(x) or [x.lower()]) for x in (t, e, n))
        for like, x in ((got[d].near_edited, b), (got[d].near_next, c)):
            errors.append(like - sum((a & x).values()) / sum((a | x).values()))
    assert np.abs(errors).mean() < 0.08 and got[0].fingerprint == got[1].fingerprint and got[0].near_next == 1.0
    assert got[4].fingerprint == got[5].fingerprint != got[6].fingerprint


def test_fingerprints_take_64_samples(spark):
    df = spark.createDataFrame([(1, "one two three"), (2, "one two four")], "doc_id long, text string")
    for r in fingerprints.fingerprint_report(df).collect():
        assert len(r.fingerprint) == len(r.edited_fingerprint) == 4 * 64
        assert r.near_next * 64 == int(r.near_next * 64)


def test_fingerprints_are_exact_where_values_are_left_out(spark):
    """With a far bound of 1 a third of the positions has no value in the first pass."""
    df = spark.createDataFrame(list(TEXTS.items()), "doc_id long, text string")
    reports = [sorted(map(tuple, fingerprints.fingerprint_report(df, samples=16, partition_bytes=9000, far=far).collect())) for far in (1, None)]
    assert reports[0] == reports[1] and len(reports[0]) == len(TEXTS)


def test_ranges_are_cut_further(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "CELLS", 4)
    df = spark.range(400).select(F.when(F.col("id") < 150, 7).otherwise(F.col("id") * F.col("id")).alias("doc_id"), F.format_string("text %s of it", "id").alias("text"))
    ranged, n = fingerprints._ranged(df, 300)
    rows = ranged.orderBy("doc_id", "tie").collect()
    assert n > 16 and [r.range for r in rows] == sorted(r.range for r in rows) and len({r.range for r in rows}) > 12 and max(r.range for r in rows) < n
    assert len({r.range for r in rows if r.doc_id == 7}) > 2
    assert fingerprints.fingerprint_report(df, samples=4, partition_bytes=300).count() == 400


def test_fingerprints_of_hard_tables(spark, docs):
    hot = docs.select("doc_id", "text").unionByName(spark.range(60).select(F.lit(3).cast("long").alias("doc_id"), F.lit("same text " * 50).alias("text")))
    out = fingerprints.fingerprint_report(hot, samples=8, partition_bytes=1000)
    assert out.count() == hot.count()
    assert fingerprints.fingerprint_report(empty(docs)).count() == 0
    one = fingerprints.fingerprint_report(docs.filter("doc_id = 0")).first()
    assert one.near_next == 1.0


def test_lm(docs):
    got = lm_scoring.score_report(docs)
    rows = {r.doc_id: r for r in got.collect()}
    assert got.columns == ["doc_id", "n_words", "log_likelihood", "mean_log_likelihood"]
    assert rows[4].n_words == 0 and rows[4].log_likelihood == 0 and rows[4].mean_log_likelihood is None
    assert rows[11].n_words == 9000 and rows[11].mean_log_likelihood > -math.log(lm_scoring.CLASSES)
    assert got.count() == docs.count() and lm_scoring.score_report(empty(docs)).count() == 0


def small_corpus():
    rng = random.Random(4)
    kinds = [f"w{i}" for i in range(30)]
    texts = [" ".join(rng.choice(kinds) for _ in range(rng.randint(0, 25))) for _ in range(40)] + ["rare words stand here but once zzé9", "a", None, "", "twice told tale of one text twice told"]
    return [(i, t) for i, t in enumerate([*texts, texts[-1], "w1 " * 300])]


@pytest.mark.parametrize("frequent", [1, 25])
def test_lm_scores_match_brute_force(spark, frequent):
    """Every word's probability from first principles: groups, words, spelling, and the other occurrences of its neighbours."""
    rows = small_corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    texts = [words(t) for _, t in rows]
    known = lm_scoring.vocabulary(df, most=20, groups=4)
    seen = collections.Counter(w for t in texts for w in t)
    least = min(n for n in set(seen.values()) if n >= 2 and sum(m >= n for m in seen.values()) <= 20)
    own_hash = lambda w: int(_text.words(*_text.strings(pa.array([w]))).hashes()[0])
    ranked = sorted((w for w in seen if seen[w] >= least), key=lambda w: (-seen[w], np.int64(np.uint64(own_hash(w)))))
    assert known.total == sum(seen.values()) and known.counts.tolist() == [seen[w] for w in ranked]
    classes = {w: i + 2 for i, w in enumerate(ranked)}
    flat, pairs = lm_scoring.train(df, known)
    spelt = collections.Counter()
    for w in (w for t in texts for w in t if w not in classes):
        spelt.update(zip([256, *w.encode()], [*w.encode(), 256], strict=True))
    assert {divmod(i, 257): n for i, n in enumerate(pairs.tolist()) if n} == spelt
    net = lm_scoring.Network(flat, known.starts())
    groups = [range(a + 2, b + 2) for a, b in zip(known.starts()[:-1], known.starts()[1:], strict=True)]
    assert len(groups) > 2 and sum(map(len, groups)) == len(ranked)
    at = lambda t, i: t[i] if 0 <= i < len(t) else None
    cls = lambda w: 0 if w is None else classes.get(w, 1)
    between = collections.defaultdict(collections.Counter)
    for t in texts:
        for i, w in enumerate(t):
            between[at(t, i - 1), at(t, i + 1)][w] += 1
    got = {r.doc_id: r for r in lm_scoring.score(df, flat, pairs, known, frequent, chunk_tokens=60, shard_tokens=50).collect()}
    for (d, _), t in zip(rows, texts, strict=True):
        total = 0.0
        for i, w in enumerate(t):
            hidden = np.tanh(net.bias + sum(net.embed[cls(at(t, i + s))] * net.scale[k] for k, s in enumerate((-2, -1, 1, 2))))
            logits = hidden @ net.group + net.group_bias
            g = next((i for i, r in enumerate(groups) if cls(w) in r), net.groups - 1)
            p = np.exp(logits[g]) / np.exp(logits).sum()
            if w in classes:
                logits = {c: net.word[c - 2] @ hidden + net.word_bias[c - 2] for c in groups[g]}
                p *= np.exp(logits[classes[w]]) / sum(map(np.exp, logits.values()))
            else:
                for a, b in zip([256, *w.encode()], [*w.encode(), 256], strict=True):
                    p *= (spelt[a, b] + 0.5) / (sum(n for (x, _), n in spelt.items() if x == a) + 0.5 * 257)
            sides = (at(t, i - 1), at(t, i + 1))
            if not all(x is None or (x in classes and seen[x] * frequent > known.total) for x in sides):
                others = between[sides].copy()
                others[w] -= 1
                m, kinds = sum(others.values()), sum(n > 0 for n in others.values())
                p = (others[w] + kinds * p) / (m + kinds) if m else p
            total += math.log(p)
        assert got[d].n_words == len(t) and math.isclose(got[d].log_likelihood, total, rel_tol=1e-4, abs_tol=1e-6)


def test_lm_tells_texts_that_occur_twice(spark):
    rng = random.Random(8)
    kinds = ["".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(3, 9))) for _ in range(12_000)]
    texts = [" ".join(rng.choice(kinds) for _ in range(80)) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts + texts[:20])), "doc_id long, text string")
    got = {r.doc_id: r.mean_log_likelihood for r in lm_scoring.score_report(df).collect()}
    assert min(got[i] for i in range(20)) > max(got[i] for i in range(20, 150)) + 1


def test_lm_learns_from_context():
    rng = np.random.default_rng(0)
    ids = rng.integers(2, 300, 4000)
    ids[1::2] = ids[::2] % 50 + 300  # each second word follows from the one before
    known = lm_scoring.Vocabulary.of(np.arange(350), 1000 - np.arange(350), 350_000)
    start = lm_scoring.Network.fresh(known)
    trainer = lm_scoring.Trainer(start.flat, known.starts())
    context = lm_scoring.windows(ids, np.array([0, len(ids)]))
    assert context[:, 0].tolist() == [0, 0, ids[1], ids[2]] and context[:, -1].tolist() == [ids[-3], ids[-2], 0, 0]
    before = start.log_probabilities(ids, context)[1::2].mean()
    for _ in range(150):
        trainer.learn(ids, context)
    assert trainer.net.log_probabilities(ids, context)[1::2].mean() > before + 1


def test_lm_gradient():
    """Each part's step goes along the derivative of the mean log-probability, by differences."""
    rng = np.random.default_rng(0)
    ids = rng.integers(1, 42, 300)
    known = lm_scoring.Vocabulary.of(np.arange(40), 100 - np.arange(40), 4000, 5)
    net = lm_scoring.Network.fresh(known)
    context = lm_scoring.windows(ids, np.array([0, 200, 300]))
    found = []

    class Spy(lm_scoring.Trainer):
        def _step(self, name, at, g, n):
            found.append((name, at, g / n))

    Spy(net.flat, known.starts()).learn(ids, context)
    mean = lambda flat: lm_scoring.Network(flat, known.starts()).log_probabilities(ids, context).mean()
    for name, at, g in found:
        rows = getattr(lm_scoring.Network(np.arange(len(net.flat), dtype=np.float32), known.starts()), name)[at]
        for _ in range(3):
            k = rng.integers(rows.size)
            up, down = net.flat.astype(np.float64), net.flat.astype(np.float64)
            up[int(rows.ravel()[k])] += 1e-4
            down[int(rows.ravel()[k])] -= 1e-4
            assert math.isclose(-(mean(up) - mean(down)) / 2e-4, g.ravel()[k], rel_tol=0.02, abs_tol=2e-5), name


def test_shards(spark, docs):
    got = sharding.shard_report(docs).collect()
    assert len(got) == docs.count()
    sizes = collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got)
    assert sizes == collections.Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "key" and 0 <= r.shard < 16 and r.grown_shard in (r.shard, 16)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    many = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("t" * 100).alias("text"))
    folder = sharding.scratch_dir(spark, "test")
    sharding.write_shards(many, folder, bucket_bytes=5000)
    written = sharding.read_shards(spark, folder, many)
    assert written.agg(F.max("bucket")).first()[0] > 40
    back = sharding.with_slots(written, written).collect()
    assert sorted(r.doc_id for r in back) == list(range(3000))
    orders = collections.defaultdict(list)
    for r in sorted(back, key=lambda r: r.slot):
        orders[r.shard].append(r.doc_id)
    assert all(o != sorted(o) for o in orders.values())
    assert sharding.shard_report(empty(docs)).count() == 0


def test_urls(spark):
    day = lambda n: datetime.date(2024, 1, n)
    entries = spark.createDataFrame(
        [("domain", "bad.com", "add", day(5)), ("domain", "bad.com", "remove", day(10)), ("domain", "bad.com", "add", day(20)), ("domain", "bad.com", "add", day(21)), ("prefix", "ok.org/x", "add", day(1)),
         ("url", "ok.org/a/b.html", "add", day(3)), ("domain", "tie.net", "add", day(4)), ("domain", "tie.net", "remove", day(4)), ("domain", None, "add", day(1)), ("domain", "com", "remove", day(1))],
        "kind string, pattern string, action string, at date",
    )
    cases = [
        ("http://WWW.Bad.com:80/p?q", 4, ""), ("http://a.bad.com/", 5, "domain:bad.com"), ("http://bad.com./", 9, "domain:bad.com"), ("http://bad.com", 10, ""), ("https://u@bad.com#f", 25, "domain:bad.com"),
        ("http://ok.org/x/y", 2, "prefix:ok.org/x"), ("http://ok.org/xy", 2, ""), ("http://ok.org/a/b.html?z=1", 3, "url:ok.org/a/b.html"), ("http://tie.net/", 4, "domain:tie.net"), (None, 9, ""), ("nonsense", 9, ""), ("http://notbad.com/", 6, ""),
    ]
    captures = spark.createDataFrame([(i, u, day(d)) for i, (u, d, _) in enumerate(cases)] + [(99, "http://bad.com", None)], "capture_id int, url string, fetched_at date")
    got = {r.capture_id: ",".join(r.matched) for r in url_filters.filter_captures(captures, entries).collect()}
    assert got == {**{i: w for i, (_, _, w) in enumerate(cases)}, 99: ""}
    assert url_filters.filter_captures(captures, empty(entries)).filter("blocked").count() == 0
    assert url_filters.filter_captures(empty(captures), entries).count() == 0


def test_deep_prefixes(spark):
    day = datetime.date(2024, 1, 1)
    entries = spark.createDataFrame([("prefix", "h.org/a/b/c/d/e", "add", day), ("prefix", "h.org/1/2/3/4/5/6/7", "add", day)], "kind string, pattern string, action string, at date")
    cases = {"http://h.org/a/b/c/d/e": 1, "http://h.org/a//b/c/d/e/f.html?q": 1, "http://h.org/a/b/c/d": 0, "http://h.org/a/b/c/d/ee": 0, "http://h.org/1/2/3/4/5/6/7/8/9": 1, "http://h.org/1/2/3/4/5/6": 0}
    captures = spark.createDataFrame([(u, u, day) for u in cases], "capture_id string, url string, fetched_at date")
    assert {r.url: r.n_active for r in url_filters.filter_captures(captures, entries).collect()} == cases


def test_captures_of_their_own_time(spark):
    """One id at two times, null ids, flapping lists and columns named like those of the operator."""
    day = lambda n: datetime.date(2024, 1, 1) + datetime.timedelta(n)
    entries = spark.createDataFrame([("domain", "b.org", a, day(n)) for n in range(0, 200, 2) for a, n in (("add", n), ("remove", n + 1))], "kind string, pattern string, action string, at date")
    rows = [(i % 3 if i % 4 else None, f"http://{h}.org/z{'/d' * (i % 9)}", day(i), "mine", i, "m") for i in range(40) for h in "ab"]
    captures = spark.createDataFrame(rows + rows[:5], "capture_id long, url string, fetched_at date, kind string, salt int, matched string")
    got = url_filters.filter_captures(captures, entries)
    assert got.columns == ["capture_id", "url", "fetched_at", "kind", "salt", "n_active", "matched", "blocked"]
    found = got.collect()
    assert len(found) == 85 and all(r.blocked == (r.url.startswith("http://b.org") and r.salt % 2 == 0) for r in found)


def test_hot_pattern(spark):
    day = datetime.date(2024, 1, 1)
    entries = spark.createDataFrame([("domain", "hot.org", "add", day), ("prefix", "hot.org/1", "add", day), ("url", "hot.org/7/7", "add", day)], "kind string, pattern string, action string, at date")
    captures = spark.range(3000).select(F.col("id").alias("capture_id"), F.concat(F.lit("http://www.hot.org/"), F.col("id")).alias("url"), F.lit(day).alias("fetched_at"))
    captures = captures.union(spark.createDataFrame([(1, "http://hot.org/1/2", day), (2, "http://hot.org/7/7?q", day), (3, "http://x.org/" + "a/" * 20_000, day)], captures.schema))
    got = url_filters.filter_captures(captures, entries).collect()
    assert len(got) == 3003 and sum(r.n_active for r in got) == 3000 + 2 + 2


def test_hot_hosts_and_captures(spark, monkeypatch):
    """Hot keys on a list and on none, one capture a third of all rows, captures without URL or time; against the plain rule, with many and few heavy keys."""
    day = lambda n: datetime.date(2024, 1, n)
    entries = spark.createDataFrame([("domain", "hot.org", "add", day(3)), ("domain", "hot.org", "remove", day(9)), ("prefix", "hot.org/p", "add", day(5)), ("url", "rare.net/u", "add", day(2))], "kind string, pattern string, action string, at date")
    rows = [("http://hot.org/same", day(4))] * 300 + [(f"http://a.hot.org/{i}", day(1 + i % 12)) for i in range(250)] + [(f"http://free.org/{i}", day(4)) for i in range(250)] + [(None, day(4))] * 90 + [("http://hot.org/p/q", None)] * 40
    rows += [("http://hot.org/p/q", day(6)), ("http://rare.net/u?x", day(2)), ("http://rare.net/u", day(1))] * 2
    captures = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n int, url string, fetched_at date")

    def rule(url, at):
        if url is None or at is None:
            return []
        on = day(3) <= at < day(9)
        return sorted((["domain:hot.org"] if "hot.org" in url and on else []) + (["prefix:hot.org/p"] if url.startswith("http://hot.org/p") and at >= day(5) else []) + (["url:rare.net/u"] if "rare.net/u" in url and at >= day(2) else []))

    for most in (2048, 20, 2):
        monkeypatch.setattr(url_filters, "HEAVY", most)
        got = {r.n: list(r.matched) for r in url_filters.filter_captures(captures, entries).collect()}
        assert got == {i: rule(*r) for i, r in enumerate(rows)}


def test_clashing_columns_of_shards(spark):
    df = spark.createDataFrame([(i, f"t{i}", 5, "own", i) for i in range(50)], "doc_id long, text string, deal int, task string, bucket long")
    folder = sharding.scratch_dir(spark, "test")
    sharding.write_shards(df, folder, n_shards=3, bucket_bytes=20)
    back = sharding.read_shards(spark, folder, df)
    assert back.columns == ["doc_id", "text", "deal", "task", "bucket", "place", "shard"] and back.filter("deal = 5 AND task = 'own'").count() == 50


def test_leaks_in_long_texts(spark):
    """An item longer than a segment, one that repeats itself, a text over several kernel blocks."""
    words_ = [f"w{i}" for i in range(40_000)]
    long_ = " ".join(words_)
    bench = spark.createDataFrame([(1, long_), (2, "again and " * 3000), (3, PASSAGE)], "item_id long, text string")
    rows = [(1, " ".join(words_[20_000:20_012])), (2, "x " * 700_000 + PASSAGE + " y" * 300), (3, "and again and again and again and again and again"), (4, long_), (5, prose(50))]
    df = spark.createDataFrame([(i, t, 3, "x") for i, t in rows], "doc_id long, text string, n_words int, hit_items string")
    for most in (decontamination.MOST_BYTES, 300_000):
        got = {r.doc_id: r for r in decontamination.find_leaks(df, bench, most_bytes=most).collect()}
        assert {d: [(s.first, s.last) for s in r.hit_spans] for d, r in got.items()} == {1: [(0, 11)], 2: [(700_000, 700_013)], 3: [(0, 9)], 4: [(0, 39_999)], 5: []}
        assert {d: r.hit_items for d, r in got.items()} == {1: ["1"], 2: ["3"], 3: ["2"], 4: ["1"], 5: []} and got[4].n_words == 40_000


def junk(i):
    return " ".join(w + RNG.choice(["***", "$$$", "%%%"]) for w in prose(60).split()) if i % 2 else prose(60).upper().replace(" ", "!! ")


def test_quality(spark, docs):
    rows = [(i, junk(i) if i % 4 == 0 else prose(80)) for i in range(1500)]
    df = spark.createDataFrame(rows + [(2000, None), (2001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(1500)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality_classifier.quality_report(df, labels).collect()}
    assert len(got) == 1502 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    out = [(r.predicted, int(d % 4 != 0)) for d, r in got.items() if r.held_out and d < 1500]
    assert sum(a == b for a, b in out) / len(out) > 0.95
    none = quality_classifier.quality_report(docs, empty(labels))
    assert {r.score for r in none.collect()} == {0.5} and none.count() == docs.count()
    assert quality_classifier.keep_good(empty(docs), labels).columns == docs.columns


def test_quality_by_hand(spark):
    """Descriptions, sample, moments and scores as plain Python has them; one text of a repeated id."""
    rows = [(i, junk(i) if i % 3 == 0 else prose(40)) for i in range(300)] + [(1, "another text of the id"), (1, None), (None, prose(9))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(300)] + [(2, 0), (4, None)], "doc_id long, quality int")
    described = quality_classifier.describe(df)
    own = lambda t: quality_classifier.features(*_text.strings(pa.array([t], pa.string())))[0]
    fold = lambda d: zlib.crc32(str(d).encode()) % 5 == 0
    held = collections.defaultdict(list)
    for d, t in rows:
        held[d].append(own(t).tobytes())
    good = [i for i in range(300) if i % 3 and i not in (2, 4) and not fold(i)]
    got = quality_classifier._positives(described, labels, 10_000)
    assert [x.tobytes() for x in got] == [min(held[i]) for i in good]
    assert len(quality_classifier._positives(described, labels, 7)) == 7
    x = np.stack([own(t) for d, t in rows if d is not None and not fold(d)]).astype(np.float64)
    net = quality_classifier.fit_on(described, labels)
    assert np.allclose(net.mean, x.mean(0), atol=1e-6) and np.allclose(net.scale[:-128], np.maximum(x.std(0), 1e-3)[:-128], atol=1e-4) and np.allclose(net.scale[-128:], 8 * np.maximum(x.std(0), 1e-3)[-128:], atol=1e-3)
    scores = collections.defaultdict(list)
    for r in quality_classifier.quality_report(df, labels).collect():
        scores[r.doc_id].append(r.score)
    w1, b1, w2, b2 = net.weights()
    for d in (0, 7, None):
        z = np.clip((own(dict(rows[:300] + rows[302:])[d]).astype(float) - net.mean) / net.scale, -8, 8)
        assert any(math.isclose(s, 1 / (1 + math.exp(-(np.tanh(z @ w1 + b1) @ w2 + b2[0]))), rel_tol=1e-9) for s in scores[d])
    assert len(scores[1]) == 3


def test_risk_by_differences():
    """The derivatives of both branches of the non-negative risk."""
    rng = np.random.default_rng(1)
    fp, fu = rng.normal(0, 1, 7), rng.normal(0, 1, 9)
    soft = lambda v: np.logaddexp(0, v).mean()
    for prior in (0.2, 0.95):
        negative = soft(fu) - prior * soft(fp)
        risk = (lambda p, u: prior * soft(-p) + soft(u) - prior * soft(p)) if negative >= 0 else (lambda p, u: prior * soft(p) - soft(u))
        sp, su = quality_classifier.slopes(fp, fu, prior)
        for i in range(7):
            e = np.eye(7)[i] * 1e-6
            assert math.isclose(sp[i], (risk(fp + e, fu) - risk(fp - e, fu)) / 2e-6, rel_tol=1e-4, abs_tol=1e-8)
        for i in range(9):
            e = np.eye(9)[i] * 1e-6
            assert math.isclose(su[i], (risk(fp, fu + e) - risk(fp, fu - e)) / 2e-6, rel_tol=1e-4, abs_tol=1e-8)


def test_class_prior():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(2, 1, 4000), rng.normal(-2, 1, 4000)
    mixed = np.concatenate([good[:2800], bad[:1200]])
    assert abs(quality_classifier.class_prior(good, mixed) - 0.7) < 0.06


def test_pipeline_stages(spark, docs, benchmark, tmp_path):
    """Each stage on what the one before kept, against brute force; the classifier against its own scores."""
    folder = f"file://{tmp_path}"
    docs.drop("shard", "n_words").write.parquet(f"{folder}/documents.parquet")
    benchmark.write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    step = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = step.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = f"{folder}/{name}"
        stage(spark, step, folder).write.parquet(path)
        step = spark.read.parquet(path)
        assert step.columns == columns
        kept[name] = [(r.doc_id, r.text, r.n_chars) for r in step.collect()]
    before = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(str, ((d, t) for d, t, _ in kept["quality"]))) == sorted(map(str, before))  # without labels every score is 0.5

    own = {i: (-1 if d is None else d, t) for i, (d, t) in enumerate(before)}
    want = brute_lines([(d + i / 100, t) for i, (d, t) in own.items()])
    assert sorted((str(t), n) for _, t, n in kept["lines"]) == sorted((want[d + i / 100][2], len(want[d + i / 100][2])) for i, (d, t) in own.items())

    rows = list(enumerate((d, t) for d, t, _ in kept["lines"]))
    same = lambda x, y: word_similarity(words(x[1]), words(y[1])) >= 0.8 - 1e-9 if words(x[1]) and words(y[1]) else not words(x[1]) and not words(y[1]) and (x[1] or "") == (y[1] or "")
    short = [(i, r) for i, r in rows if len(words(r[1])) < 1000]  # the only long text is like no other
    groups = brute_groups(short, same)
    firsts = collections.defaultdict(list)
    for i, r in short:
        firsts[groups[i]].append(r[0])
    least = [min((d for d in g if d is not None), default=None) for g in firsts.values()] + [r[0] for _, r in rows if len(words(r[1])) >= 1000]
    assert sorted(map(str, least)) == sorted(str(d) for d, _, _ in kept["near_duplicates"])

    windows_ = set()
    for r in benchmark.collect():
        w = words(r.text)
        k = min(10, len(w))
        windows_ |= {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set()
    leaks = lambda t: any(tuple(w[i : i + k]) in windows_ for w in [words(t)] for k in {len(x) for x in windows_} for i in range(len(w) - k + 1))
    assert sorted(map(str, kept["leaks"])) == sorted(str(r) for r in kept["near_duplicates"] if not leaks(r[1]))

    path = _tokens.tokenizer_path()
    pieces = collections.Counter()
    for d, t, _ in kept["leaks"]:
        ids = [*_tokens.tokenizer(path).encode(t or "", add_special_tokens=False).ids, 2]
        for k, (start, n) in enumerate(packing.cut(len(ids), 1024)):
            pieces[d, k, start, n, zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes())] += 1
    packed = corpus_pipeline.run(spark, folder).select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    assert collections.Counter(map(tuple, packed)) == pieces
    assert {r.doc_id for r in packed} == {0, 4, 6, 8, 9, 10, 11, 13, 15, None}
