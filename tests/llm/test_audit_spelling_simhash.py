"""Filter audit, spelling variants and SimHash groups against brute force, and their defined cases."""

import collections
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from strandline.llm import filter_audit, simhash, spelling

RNG = random.Random(11)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = ["".join(RNG.choice("abcdefgéß") for _ in range(RNG.randint(3, 8))) for _ in range(300)]
SPACED = re.compile("[^\x20\x09-\x0d]+")


def prose(n):
    return " ".join(RNG.choice(WORDS) for _ in range(n))


BASE = prose(200)
EDITED = BASE.split()
EDITED[50] = "changed"
TEXTS = [
    (0, BASE), (1, BASE), (2, " ".join(EDITED)), (3, None), (4, ""), (5, "one"), (6, "ONE"), (7, "one two"), (8, "SHOUTING ALL OF IT " * 20), (9, "50 % & more | less " + prose(60)),
    (10, "\t \n\x0b\x0c\r "), (11, "a\x1cb c d " * 30), (12, "日本語 " * 60), (13, prose(7000)), (14, prose(70)), (14, BASE), (15, "$"), (16, prose(55)), (None, BASE), (None, prose(60)), (None, None),
]
ROWS = [(i, t, "en", None if (i or 0) % 5 == 4 else f"s{(i or 0) % 3}", 1, True, 0, "clash") for i, t in TEXTS]
SCHEMA = "doc_id long, text string, lang string, source string, fails int, good boolean, fp int, word string"
LABELS = [(0, 1, 0), (1, 1, 1), (8, 0, 1), (9, None, None), (9, 1, 0), (14, 1, 1), (None, 1, 1), (99, 1, 1), (13, 1, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def brute_audit(rows, labels):
    texts = collections.defaultdict(list)
    for i, t, *_ in rows:
        texts[t or ""].append(i)
    good, toxic = ({d for d, *m in labels if d is not None and m[k] == 1} for k in (0, 1))
    parts = collections.defaultdict(list)
    for i, t, _, source, *_ in rows:
        t = t or ""
        w = SPACED.findall(t)
        fails = {
            "A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search("[#$%&*|]", t)),
            "E": i is not None and any(j is not None and j < i for j in texts[t]),
        }
        parts[source or ""].append((fails, i in good, i in toxic))
    out = {}
    for part, own in parts.items():
        removed = collections.Counter()
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                lost = [r for r in left if r[0][f]]
                left = [r for r in left if not r[0][f]]
                failing = [r for r in own if r[0][f]]
                removed[f] += len(lost)
                out[part, "".join(order), step] = [len(left), len(lost), len(failing) - len(lost), sum(sum(r[0].values()) == 1 for r in failing), sum(r[1] for r in lost), sum(r[2] for r in lost)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(removed[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def audited(docs, labels):
    return {tuple(r[:3]): tuple(r[3:]) for r in filter_audit.filter_report(docs, labels).collect()}


def test_audit(docs, labels):
    got = audited(docs, labels)
    assert got == brute_audit(ROWS, LABELS)
    assert {k[0] for k in got} == {"", "s0", "s1", "s2"} and len(got) == 4 * 600
    assert audited(docs.filter("false"), labels) == {}
    assert {v[4:6] for v in audited(docs, labels.filter("false")).values()} == {(0, 0)}


def test_audit_of_other_filters(spark):
    """Any filters and labels; very many parts, each of a few rows, pass through in bounded memory."""
    rows = [(f"p{i % 5000}", RNG.randrange(4), RNG.random() < 0.5) for i in range(12000)]
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.kind_lost, r.shapley) for r in filter_audit.interaction_audit(spark.createDataFrame(rows, "part string, fails int, kind boolean"), ["X", "Y"], ["kind"]).collect()}
    assert len(got) == 5000 * 4
    for part in ("p0", "p77", "p4999"):
        own = [r for r in rows if r[0] == part]
        after_x = [r for r in own if not r[1] & 1]
        lost = [r for r in after_x if r[1] & 2]
        assert got[part, "XY", 1][:2] == (len(after_x), len(own) - len(after_x))
        assert got[part, "XY", 2] == (len(after_x) - len(lost), len(lost), sum(r[2] for r in lost), len(lost) + sum(r[1] >> 1 for r in own))


def test_audit_of_long_text(monkeypatch):
    text = (prose(20000) + " ").encode()
    want = filter_audit.failures(text)
    monkeypatch.setattr(filter_audit._text, "pieces", lambda t: (t[i : i + 1000] for i in range(0, 0, 1000)))
    assert filter_audit.failures(b"") == 1
    monkeypatch.undo()
    monkeypatch.setattr(filter_audit._text.pieces, "__defaults__", (1000,))
    assert len(list(filter_audit._text.pieces(text))) > 50 and b"".join(filter_audit._text.pieces(text)) == text
    assert filter_audit.failures(text) == want


def brute_spelling(rows):
    n = collections.Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}

    def near(a):
        made = {a[:i] + a[i + 1 :] for i in range(len(a))}
        letters = {c for w in n for c in w}
        made |= {a[:i] + c + a[j:] for i in range(len(a) + 1) for c in letters for j in (i, i + 1)}
        return [w for w in made - {a} if w in n]

    form, out = {}, {}
    for w in n:
        found = near(w)
        best = min(found, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
        out[w] = [n[w], len(found), n[form[w]] if form[w] else None]
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, *out[w])
    return out


def spelled(docs):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_groups(docs).collect()}


def variants(times, sizes=(4, 9)):
    """Rows of words and edits of them, in falling numbers, so that chains of forms come about."""
    out = []
    for k in range(times):
        word = "".join(RNG.choice("abcdefgéß") for _ in range(RNG.randint(*sizes)))
        count = 40
        while count > 2:
            out += [word] * count
            count //= RNG.choice((1, 2, 3)) + 1
            at = RNG.randrange(len(word) + 1)
            word = word[:at] + RNG.choice(("", "x", "é")) + word[at + RNG.randint(0, 1) :]
    RNG.shuffle(out)
    return [(i, " ".join(out[i::50])) for i in range(50)]


def test_spelling(spark, docs):
    rows = variants(150) + [(i, t) for i, t, *_ in ROWS]
    got = spelled(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert got == brute_spelling(rows) and sum(v[3] > 0 for v in got.values()) > 100 and any(v[0] and v[0] != v[1] for v in got.values())
    assert spelled(docs) == brute_spelling([r[:2] for r in ROWS])
    assert spelled(docs.filter("false")) == {}


def test_spelling_with_hot_halves(spark, monkeypatch):
    """Most words share a beginning or an end: blocks and lookups by deletions find what the lists find."""
    made = ["extra" + "".join(RNG.choice("abc") for _ in range(RNG.randint(4, 6))) for _ in range(300)] + ["".join(RNG.choice("abc") for _ in range(RNG.randint(4, 6))) + "ations" for _ in range(300)]
    rows = [(i, " ".join(made)) for i in range(4)]
    want = brute_spelling(rows)
    for block, listed in ((4096, 32), (20, 2), (7, 1000)):
        monkeypatch.setattr(spelling, "BLOCK", block)
        monkeypatch.setattr(spelling, "LISTED", listed)
        words = spark.createDataFrame([(w, v[2]) for w, v in want.items()], "word string, n long")
        got = {r.word: (r.n_near, r.best_n) for r in spelling.near_words(words).collect()}
        assert {w: v[3] for w, v in want.items() if v[3]} == {w: v[0] for w, v in got.items()}
    assert spelled(spark.createDataFrame(rows, "doc_id long, text string")) == want


def test_spelling_of_long_text(spark, monkeypatch):
    rows = [(1, prose(4000)), (2, "a" * 3000 + " " + "a" * 2999 + " " + "a" * 3000)]
    monkeypatch.setattr(spelling._text.pieces, "__defaults__", (500,))
    assert spelled(spark.createDataFrame(rows, "doc_id long, text string")) == brute_spelling(rows)


def test_one_edit():
    for a in ("", "a", "ab", "abc", "abca", "aab"):
        for b in ("", "a", "b", "ab", "ba", "acb", "abc", "abd", "aabc", "bca"):
            made = {a[:i] + a[i + 1 :] for i in range(len(a))} | {a[:i] + c + a[j:] for i in range(len(a) + 1) for c in "abcd" for j in (i, i + 1)}
            assert spelling.one_edit(a, b) == (b in made - {a}), (a, b)


def brute_fingerprint(text):
    w = SPACED.findall((text or "").translate(LOWER))
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(values, links):
    up = {v: v for v in values}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {v: find(v) for v in values}


def true_links(values):
    u = np.array(sorted(values), np.uint64)
    return [(int(u[i]), int(x)) for i in range(len(u)) for x in u[np.bitwise_count(u ^ u[i]) <= 3] if x != u[i]]


def test_simhash(spark, docs):
    near = [(100 + i, " ".join(EDITED[: 60 + i % 3] + EDITED[60 : 200 - i])) for i in range(12)]
    rows = [r[:2] for r in ROWS] + near
    made = docs.select("doc_id", "text").union(spark.createDataFrame(near, "doc_id long, text string"))
    prints = [brute_fingerprint(t) for _, t in rows]
    root = roots(set(prints), true_links(set(prints)))
    least = {}
    for (i, _), p in zip(rows, prints, strict=True):
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    want = collections.Counter((i, f"{p:016x}", least.get(root[p])) for (i, _), p in zip(rows, prints, strict=True))
    got = collections.Counter(map(tuple, simhash.simhash_report(made).collect()))
    assert got == want
    assert collections.Counter(map(tuple, simhash.simhash_report(docs.unionByName(docs)).collect())) == collections.Counter({k: 2 * v for k, v in collections.Counter(map(tuple, simhash.simhash_report(docs).collect())).items()})
    assert simhash.simhash_report(docs.filter("false")).collect() == []


def test_simhash_of_long_text(monkeypatch):
    texts = [BASE * 30, "x " * 5, "word " * 3000, "y" * 5000 + " z", " " * 4000, "a b", " " * 900 + "a" + " " * 900 + "b" + " " * 900 + "c d"]
    want = [brute_fingerprint(t) for t in texts]
    assert simhash.simhashes(pa.array(texts)).tolist() == want
    monkeypatch.setattr(simhash._text.pieces, "__defaults__", (300,))
    assert [simhash._long(t.encode().lower(), 3) for t in texts] == want


def test_simhash_links_in_dense_cells(spark):
    """A dense group among others; blocks of any size give the same components, and never all pairs."""
    bits, base = RNG.sample(range(64), 16), RNG.getrandbits(64)
    values = {base ^ sum(1 << b for b in RNG.sample(bits, RNG.randint(0, 8))) for _ in range(900)} | {RNG.getrandbits(64) for _ in range(600)}
    true = true_links(values)
    want = roots(values, true)
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    for block in (1 << 14, 40, 7):
        got = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.linked(df, block=block).collect()]
        assert set(got) <= set(true) and roots(values, got) == want
        assert block < 100 or len(got) < len(true) / 2


def test_manhattan_is_a_lower_bound():
    x, y = (np.array([RNG.getrandbits(64) for _ in range(500)], np.uint64) for _ in range(2))
    y[:250] = x[:250] ^ np.uint64(1 << 9 | 1 << 10 | 1 << 40)
    bound = np.bitwise_count(simhash._thermometer(x) ^ simhash._thermometer(y))
    seg = lambda v: np.stack([(v >> np.uint64(2 * i) & np.uint64(1)) + (v >> np.uint64(2 * i + 1) & np.uint64(1)) for i in range(32)]).astype(int)
    assert (bound == abs(seg(x) - seg(y)).sum(0)).all() and (bound <= np.bitwise_count(x ^ y)).all()
