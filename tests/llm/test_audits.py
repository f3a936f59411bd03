"""Filter audit, resampling and decontamination against brute force on messy rows."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from skeinwork.llm import filter_audit, ngrams, resampling, winnowing
from skeinwork.llm import queries as registered

from ..duck import connect, same

EXTRA = "doc_id long, text string, source string, lang string, part string, label int, mask int, row long, print binary, win long, item string, span int, rank long, n long"
WORDS = "alpha Beta gamma DELTA épsilon zeta42 eta θήτα iota kappa".split()


def prose(r, n):
    return "".join(r.choice(WORDS) + r.choice(["", "", str(r.randrange(9))]) + r.choice([" ", ", ", "\n", " - "]) for _ in range(n))


@pytest.fixture(scope="module")
def items():
    r = random.Random(3)
    long = prose(r, 60)
    return [(1, prose(r, 30)), (20, prose(r, 12)), (3, "Kappa iota"), (4, "one exact item of seven plain words"), (5, None), (6, " .,"), (7, long), (70, long), (8, "ten words " * 5), (None, "a null id holds these words and some more of them"), (7, "repeated id with words of its own, ten of them or so")]


@pytest.fixture(scope="module")
def rows(items):
    r = random.Random(5)
    text = dict(enumerate(t for _, t in items))
    made = [None, "", " ", "é", "x" * 300, "#", prose(r, 49), prose(r, 50), prose(r, 55) + "#", "THE " * 60, "a b c " * 40, prose(r, 4000)]
    made += [prose(r, 20) + text[0] + " " + prose(r, 20), text[0][:80], "so ONE exact; item of seven plain words.", "one exact item of seven plain word", "kappa, iota", prose(r, 9) + text[6] + prose(r, 5), text[6], text[6], "ten words ten words ten words ten words ten words ten words", "a null id holds these words and some more of them"]
    made += [prose(r, r.randrange(15, 90)) for _ in range(60)] + ["same text of some words here"] * 40
    out = [(k * 3 % 211, t, (None, "", "web", "hot", "hot")[k % 5]) for k, t in enumerate(made)]
    return out + [(out[7][0], made[7], "web"), (out[7][0], made[7], "hot"), (None, made[8], "web"), (None, made[8], "web"), (out[9][0], "another text of a known id", "hot")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*x, "en", "p", 1, 2, 3, bytearray(b"x"), 4, "i", 5, 6, 7) for x in rows], EXTRA).repartition(3)


@pytest.fixture(scope="module")
def benchmark(spark, items):
    return spark.createDataFrame([(i, t, 1, "w") for i, t in items], "item_id long, text string, print long, window string")


LABELS = [(0, 1, 0), (3, 0, 1), (6, 1, 1), (6, 0, 0), (21, None, None), (24, None, 1), (27, 1, None), (None, 1, 1), (9999, 1, 1)]


def labels_of(spark, rows=LABELS):
    return spark.createDataFrame([(*x, "extra", 1) for x in rows], "doc_id long, quality int, toxic int, part string, label int")


def audit_by_hand(rows, labels):
    texts = collections.defaultdict(list)
    for i, t, _ in rows:
        if i is not None:
            texts[t or ""].append(i)
    docs = []
    for i, t, s in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and min(texts[t]) < i}
        mine = [x for x in labels if x[0] == i and i is not None]
        docs.append((s or "", {k for k, v in fails.items() if v}, any(q == 1 for _, q, _ in mine), any(x == 1 for _, _, x in mine)))
    out, shapley = [], collections.Counter()
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, f in enumerate(order):
                gone = [d for d in left if f in d[1]]
                stay = [d for d in left if f not in d[1]]
                shapley[part, f] += len(gone)
                out.append([part, order, step + 1, len(stay), len(gone), sum(f in d[1] and bool(d[1] & set(order[:step])) for d in own), sum(d[1] == {f} for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone)])
                left = stay
    return {tuple([*x, shapley[x[0], x[1][x[2] - 1]]]) for x in out}


def test_audit_equals_filtering_by_hand(spark, docs, rows):
    got = [tuple(r) for r in filter_audit.filter_audit(docs, labels_of(spark)).collect()]
    assert len(got) == 600 * len({s or "" for _, _, s in rows}) and set(got) == audit_by_hand(rows, LABELS)
    assert {r[:-3] for r in set(got)} == {tuple(r)[:-3] for r in filter_audit.filter_audit(docs, labels_of(spark, [])).collect()}
    assert filter_audit.filter_audit(docs.limit(0), labels_of(spark)).count() == 0


def test_parity_sums_invert_to_the_masks(spark):
    r = random.Random(1)
    masks = [("p" if k % 3 else "", r.randrange(4), min(r.randrange(32), r.randrange(32))) for k in range(500)]
    cells = filter_audit.mask_cells(filter_audit.parity_sums(spark.createDataFrame(masks, "part string, label int, mask int"))).collect()
    want = collections.Counter(masks)
    assert {(c["part"], c["label"], m): n for c in cells for m, n in enumerate(c["cells"]) if n} == want


def plain_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def features(t):
    w = plain_words(t)
    return w + [f"{a} {b}" for a, b in itertools.pairwise(w)]


@pytest.mark.parametrize("limit", [40, 1 << 22])
def test_crcs_are_those_of_the_joined_words(limit):
    r = random.Random(2)
    texts = [None, "", "a", prose(r, 300), "x" * 70 + " " + "y" * 200 + " z", " ".join("é" * k for k in range(1, 90)), prose(r, 5), "w" * 500, "..", prose(r, 40)]
    got, before = collections.defaultdict(list), None
    for data, bounds, first, on in ngrams.pieces(pa.chunked_array([pa.array(texts)]), limit):
        rows, crcs, n, before = ngrams.feature_crcs(data, bounds, before if on else None)
        assert len(n) == len(bounds) - 1
        for a, c in zip(rows.tolist(), crcs.tolist(), strict=True):
            got[a + first].append(c)
    for k, t in enumerate(texts):
        assert sorted(got[k]) == sorted(zlib.crc32(f.encode()) for f in features(t))


def resampling_by_hand(rows, items):
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s = collections.Counter(bucket(f) for _, t, _ in rows for f in features(t))
    t = collections.Counter(bucket(f) for _, x in items for f in features(x))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10000) / ((s[b] + 1) * (t.total() + 10000)))) for b in range(10000)]
    out = []
    for k, (i, x, _) in enumerate(rows):
        f = features(x)
        weight = sum(gain[bucket(y)] for y in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(plain_words(x)), k])
    able = sorted((x for x in out if x[5] >= 20), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    for k, x in enumerate(able[: 25 * len(able) // 100]):
        x[4] = k + 1
    return out


@pytest.mark.parametrize("limit", [64, 1 << 22])
def test_resampling_equals_the_formula(docs, rows, items, benchmark, limit):
    got = [(r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in resampling.resampled(docs, benchmark, batch_bytes=limit).collect()]
    want = [tuple(x[:5]) for x in resampling_by_hand(rows, items)]
    assert collections.Counter(got) == collections.Counter(want) and max(x[4] or 0 for x in got) > 10
    assert resampling.resampled(docs.limit(0), benchmark).count() == 0


def test_resampling_of_repeated_rows_and_an_empty_target(spark, docs, benchmark):
    alike = spark.createDataFrame([(None if k % 2 else 4, "one two three four " * 6) for k in range(41)], "doc_id long, text string")
    got = resampling.resampled(alike, benchmark.limit(0)).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 11)) and len(got) == 41
    assert len({(r.doc_id, r.score) for r in got}) == 2
    assert resampling.bucket_counts(docs.limit(0)).sum() == 0


def hits_by_hand(rows, items):
    spans = [(str(i) if i is not None else "", w, min(10, len(w))) for i, t in items if (w := plain_words(t))]
    windows = collections.defaultdict(set)
    for i, w, n in spans:
        for k in range(len(w) - n + 1):
            windows[tuple(w[k : k + n])].add(i)
    out = []
    for i, t, _ in rows:
        w = plain_words(t)
        hit, held = set(), set()
        for n in {n for _, _, n in spans}:
            for k in range(len(w) - n + 1):
                if own := windows.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    held |= own
        out.append((i, len(w), len(hit), len(held), hashlib.sha256(",".join(sorted(held)).encode()).hexdigest(), bool(hit)))
    return collections.Counter(out)


@pytest.mark.parametrize("limit", [64, 1 << 22])
def test_decontamination_equals_all_windows(docs, rows, items, benchmark, limit):
    got = collections.Counter(tuple(r) for r in winnowing.decontaminate(docs, benchmark, limit).collect())
    want = hits_by_hand(rows, items)
    assert got == want and sum(n for x, n in want.items() if x[5]) > 8


def test_decontamination_of_empty_tables(docs, rows, benchmark):
    assert winnowing.decontaminate(docs.limit(0), benchmark).count() == 0
    got = winnowing.decontaminate(docs, benchmark.limit(0)).collect()
    assert len(got) == len(rows) and not any(r.contaminated or r.n_hit or r.n_items for r in got)


def test_shared_windows_keep_one_fingerprint():
    r = random.Random(7)
    for span in (1, 4, 5, 6, 10):
        for _ in range(20):
            shared = np.array([r.randrange(4) for _ in range(span)], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            texts = [np.concatenate([np.array([r.randrange(2**60) for _ in range(a)], np.uint64), shared, np.array([r.randrange(2**60) for _ in range(5)], np.uint64)]) for a in (0, 3, 17)]
            kept = set()
            for a, h in zip((0, 3, 17), texts, strict=True):
                starts, place, prints = winnowing.window_minima(h, np.zeros(len(h), np.int64), span)
                k = starts.tolist().index(a)
                kept.add((int(prints[k]), int(place[k]) - a))
            assert len(kept) == 1


@pytest.mark.parametrize("name", ["op11_filter_audit", "op12_resampling", "op13_decontamination"])
def test_registered_query_equals_its_sql(spark, sf_dir, name):
    same(registered.queries()[name](spark, sf_dir), connect(sf_dir), registered.oracle_sql()[name])
