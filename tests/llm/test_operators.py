"""Each operator against a brute-force version on messy rows: nulls, empty and long texts, ties, repeats, clashing names."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

from skeinwork.llm import common, exact_dedup, links, mixing, near_dup, packing, paragraphs, prefix_free, quality, secrets, token_counts, token_files, tokens
from skeinwork.llm import queries as registered
from skeinwork.llm.common import batches_by_bytes

from ..duck import connect, same

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()
SPLIT = r"[^\x20\x09-\x0D]+"
TEXT = "doc_id long, text string, lang string, source string, n_chars long, id long, key string, band int, rep long, label string, digest string, salt int, start long, n long, weight double, block int, print string, tokens long"


def prose(r, n, lines=True):
    return "".join(r.choice(WORDS) + str(r.randrange(40)) + (r.choice([" ", " ", " ", "  ", "\n", "\t"]) if lines else " ") for _ in range(n))


def edited(r, text, share):
    w = text.split(" ")
    for k in range(len(w)):
        if r.random() < share:
            w[k] = "edit" + str(r.randrange(10**6))
    return " ".join(w)


@pytest.fixture(scope="module")
def texts():
    r = random.Random(11)
    base = [prose(r, n) for n in (3, 60, 80, 200, 300)]
    out = [None, "", " ", "\n", " \n\t", "one", "two words", "é ñ 中 🙂", base[1], base[1], base[1].replace(" ", "  "), base[2] + " "]
    out += [edited(r, base[k], s) for k in (2, 3, 4) for s in (0.0, 0.01, 0.02, 0.05, 0.2, 0.5)]
    out += ["spam spam spam " * 60, "x" * 9000, prose(r, 9000), base[3] + "\n" + prose(r, 40, False) + "\n" + base[3]]
    passage = prose(r, 60, False)
    out += [prose(r, 30) + "\n" + passage + "\n" + prose(r, 30) for _ in range(4)]
    out += [f"token = {hashlib.sha1(b'x').hexdigest()} and password='short' AKIA{'Q' * 16} AKIAQ {'ab12' * 8} secret=token=\"abcdefghijklmnop\" \U0001f642 API_KEY : {'A' * 12}"]
    return [(k * 3, t) for k, t in enumerate(out)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", None if i % 5 == 0 else "hot" if i % 2 else f"s{i % 4}", 0, 1, "k", 2, 3, "l", "d", 4, 5, 6, 0.5, 7, "p", 8) for i, t in texts]
    return spark.createDataFrame(rows, TEXT).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], TEXT)


# 1


def base_spans(t):
    a = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    out = [(m.start(), 0, m.end()) for m in a.finditer(t) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 16]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(out))


@pytest.fixture(scope="module")
def model(spark):
    """Fitted on the labelled documents of the small table; the tests' own strings are not among them."""
    sf = "/root/testdata/sf0.01"
    return secrets.fit(secrets.labelled_samples(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")))


NAMES = "account buffer channel database encoder factory handler instance library message number object parser query record schema template upload value window".split()


def markov_spans(t, model):
    """The Markov spans of a text, by character and by loop."""
    covered = list(t)
    for s in filter(None, base_spans(t).split(",")):
        _, a, b = s.split(":")
        covered[int(a) : int(b)] = "\0" * (int(b) - int(a))
    code, size, out = secrets.ALPHABET, len(secrets.ALPHABET), []
    for m in re.finditer("[A-Za-z0-9+/_=.-]{20,}", "".join(covered)):
        x = [model[code.index(a) * size + code.index(b)] for a, b in zip(m[0], m[0][1:])]
        x = [float(f"{v:.6g}") for v in x]
        if sum(x) >= max(secrets.LEAST_LLR, secrets.LEAST_LLR_EACH * len(x)):
            out.append((m.start(), m.end()))
            continue
        best, start, end, run, begin = 0.0, 0, 0, 0.0, 0
        for k, v in enumerate(x):
            begin, run = (begin if run > 0 else k), max(run, 0.0) + v
            if run > best:
                best, start, end = run, begin, k + 2
        if end - start >= secrets.LEAST_STRETCH and best >= max(secrets.LEAST_LLR, secrets.LEAST_LLR_EACH * (end - start - 1)):
            out.append((m.start() + start, m.start() + end))
    return [f"markov:{a}:{b}" for a, b in out]


def test_markov_spans_equal_a_loop(spark, model):
    r = random.Random(3)
    parts = ["token=", "AKIA", "api_key: ", "apikey", " ", "\n", "/", "_", "\ue005", "\ue03a", "🙂", "é"] + NAMES[:6]

    def piece():
        k = r.randrange(6)
        n = r.choice([3, 11, 15, 16, 20, 40])
        return r.choice(parts) if k < 3 else "".join(r.choice("0123456789abcdef") for _ in range(n)) if k == 3 else "".join(r.choice(secrets.ALPHABET) for _ in range(n)) if k == 4 else "".join(r.choice("ABCDEFGHIJ0123456789") for _ in range(n))

    rows = [(k, "".join(piece() for _ in range(r.choice([1, 4, 12, 40, 400])))) for k in range(400)]
    rows += [(400, "ab12" * 3 + "abcapi_key=" + "Zq9" * 12), (401, "AKIA" + "Q" * 12 + "0123456789" * 3 + "Zq9x" * 8)]
    got = {x.doc_id: x for x in secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    found = 0
    for k, t in rows:
        assert got[k].base_sha256 == hashlib.sha256(base_spans(t).encode()).hexdigest()
        want = markov_spans(t, model)
        assert [s for s in got[k].spans.split(",") if s.startswith("markov")] == want, (k, t)
        found += len(want)
    assert found > 200


def test_secrets_of_one_text_with_very_many_spans(spark, model):
    r = random.Random(4)
    texts = [(1, " ".join(f"{r.getrandbits(64):016x}" for _ in range(60_000))), (2, " ".join("".join(r.choice(secrets.ALPHABET) for _ in range(24)) for _ in range(20_000))), (1, "token=" + "x" * 12), (None, None)]
    rows = secrets.find_secrets(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()
    got = {(x.doc_id, len(x.spans) > 100): x for x in rows}
    assert len(rows) == 4 and got[1, True].n_hex == 60_000 and got[None, False].spans == "" and got[1, False].spans == "assign:0:18"
    for k in (0, 1):
        i, t = texts[k]
        assert got[i, True].base_sha256 == hashlib.sha256(base_spans(t).encode()).hexdigest()
        assert [s for s in got[i, True].spans.split(",") if s.startswith("markov")] == markov_spans(t, model)


def test_models_of_labelled_documents(spark):
    key = hashlib.sha1(b"k").hexdigest()
    docs = spark.createDataFrame([(1, f"the quick brown foxes token={key} jumped", "x"), (2, f"secret: {key[:20]} bad words here", "x"), (3, "never labelled words", "x"), (4, None, "x"), (None, "no id at all", "x")], "doc_id long, text string, s string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (4, 1), (None, 1), (9, 1)], "doc_id long, quality int")
    rows = secrets.labelled_samples(docs, labels).collect()
    assert sorted(r.s for r in rows if r.random) == sorted([key, key[:20]])
    plain = [r.s for r in rows if not r.random]
    assert {"brown", "foxes", "jumped"} - {"brown", "foxes"} <= set(plain) and len(plain) == 2 and not any("bad" in s.lower() for s in plain)
    assert {r.s for r in secrets.labelled_samples(docs, labels, 1).collect() if r.random} == {key}
    assert max(map(abs, secrets.fit(secrets.labelled_samples(docs, labels.where("false"))))) < 1e-9


def test_secrets_equal_the_patterns(docs, texts, model, empty):
    got = {r.doc_id: r for r in secrets.find_secrets(docs, model).collect()}
    for i, t in texts:
        want = base_spans(t or "")
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(want.count(k) for k in ("assign", "access", "hex"))
        assert [s for s in got[i].spans.split(",") if s and not s.startswith("markov")] == [s for s in want.split(",") if s]
    assert secrets.find_secrets(empty, model).count() == 0


def test_markov_models_tell_held_out_strings_apart(spark, model):
    import base64

    r = random.Random(99)
    rand = [base64.b64encode(r.randbytes(24)).decode().rstrip("=") for _ in range(200)]
    plain = [r.choice(["_", "-", "."]).join(r.choice(NAMES) for _ in range(4)) for _ in range(200)] + ["internationalisation", "verantwortungsbewusstsein", "/usr/local/share/applications/x"]
    df = spark.createDataFrame([(k, f"see {s} there") for k, s in enumerate(rand + plain)], "doc_id long, text string")
    got = {x.doc_id: x for x in secrets.find_secrets(df, model).collect()}
    hits = sum(got[k].n_markov for k in range(200))
    assert hits >= 190 and sum(got[k].n_markov for k in range(200, 200 + len(plain))) <= 2
    k = next(k for k in range(200) if got[k].n_markov)
    assert got[k].spans.startswith("markov:4:")


def test_markov_models_find_keys_within_longer_runs(spark, model):
    import base64

    r = random.Random(7)
    keys = [base64.b64encode(r.randbytes(n * 3 // 4)).decode()[:n] for n in (32, 40) for _ in range(50)]
    around = [("/var/lib/service/data/client/connection/", ""), ("https/example.com/service/config/database.settings.key=", ""), ("NAME_of_the_setting=", "/with/ordinary/path/after/it"), ("AKIA" + "Q" * 16 + "/", "")]
    rows = [(f"see {a}{k}{b} there", len(f"see {a}"), len(k)) for a, b in around for k in keys]
    got = {x.doc_id: x.spans for x in secrets.find_secrets(spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(rows)], "doc_id long, text string"), model).collect()}
    for g in range(len(around)):
        hits = 0
        for i in range(g * len(keys), (g + 1) * len(keys)):
            _, at, n = rows[i]
            spans = [tuple(map(int, s.split(":")[1:])) for s in got[i].split(",") if s.startswith("markov")]
            hits += any(min(b, at + n) - max(a, at) >= 0.8 * n for a, b in spans)
        assert hits >= 0.9 * len(keys), (around[g], hits)


# 2


def test_exact_dedup(spark, docs, texts, empty):
    got = {r.doc_id: r for r in exact_dedup.exact_duplicates(docs).collect()}
    groups = collections.defaultdict(list)
    for i, t in texts:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i))
    assert len(got) == len(texts)
    for i, t in texts:
        n = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        keep = min(groups[n])[1]
        assert (got[i].keep_id, got[i].group_size, got[i].kept, got[i].text_sha256) == (keep, len(groups[n]), keep == i, hashlib.sha256(n.encode()).hexdigest())
    kept = exact_dedup.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact_dedup.exact_duplicates(empty).count() == 0
    rows = spark.createDataFrame([(None, "a"), (None, "a"), (4, "a "), (4, "a "), (None, "z")], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.keep_id or -1, r.group_size, r.kept) for r in exact_dedup.exact_duplicates(rows).collect())
    assert got == [(-1, -1, 1, True), (-1, 4, 4, False), (-1, 4, 4, False), (4, 4, 4, True), (4, 4, 4, True)]


def test_exact_dedup_sql(spark, sf_dir):
    same(registered.op2_exact_dedup(spark, sf_dir), connect(sf_dir), exact_dedup.ORACLE)


# 3


def test_quality(docs, texts, empty):
    got = {r.doc_id: r for r in quality.judge(docs).collect()}
    for i, t in texts:
        t = t or ""
        w = re.findall(SPLIT, t)
        c = collections.Counter(zip(w, w[1:], w[2:], strict=False))
        cover = {j for k in range(len(w) - 2) if c[tuple(w[k : k + 3])] > 1 for j in (k, k + 1, k + 2)}
        lines = [x for x in t.split("\n") if re.search(SPLIT, x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover))
        x = got[i]
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == want
        assert x.base_failed == (len(w) < 50 or 100 * len(cover) > 50 * len(w)) and not (x.base_failed and x.kept)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, x in got.items() if x.kept}
    assert quality.judge(empty).count() == 0 and quality.keep_good(empty).count() == 0


def test_compression_bands(spark):
    r = random.Random(2)
    good = prose(r, 1500, False)
    noise = " ".join("".join(chr(r.randrange(0x4E00, 0x9000)) for _ in range(6)) for _ in range(1500))
    again = " ".join(f"{w} same line over and over" for w in range(3)) + " "
    rows = [(1, good), (2, noise), (3, "".join(f"{k} {again}" for k in range(300))), (4, good[:6000] + ("ab cd ef gh ij kl %d " * 1).join(["mn op"] * 900))]
    got = {x.doc_id: x for x in quality.judge(spark.createDataFrame(rows, "doc_id long, text string"), quality.Bands(rows=((0, 0.0, 4.0), (1024, 1.6, 4.5)))).collect()}
    assert got[1].kept and not got[2].kept and not got[3].kept and got[3].ratio > 4.5 and got[2].ratio < 1.6
    assert got[4].n_bad_chunks > 0


def test_fitted_bands_hold_on_the_other_half(spark, empty):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    bands = quality.fit_bands(docs, labels.where("doc_id % 2 = 0"))
    assert [r[0] for r in bands.rows] == [r[0] for r in quality.ROWS] and all(a <= b for _, a, b in bands.rows + bands.chunk_rows)
    judged = quality.judge(docs, bands).where("not base_failed").join(labels.where("doc_id % 2 = 1"), "doc_id").groupBy("quality").agg(F.count("*").alias("n"), F.count_if("kept").alias("kept")).collect()
    n = {r.quality: (r.n, r.kept) for r in judged}
    assert n[1][1] >= 0.98 * n[1][0] and n[0][1] <= 0.6 * n[0][0]
    none = quality.fit_bands(empty, labels)
    assert all(a == 0 and b == float("inf") for _, a, b in none.rows) and quality.judge(docs, none).where("not kept and not base_failed").count() == 0
    # one good text of one class: the others take its limits, and extra columns don't matter
    one = quality.fit_bands(docs.where("length(text) between 1000 and 1400").limit(1).withColumn("size", F.lit(1)), docs.select("doc_id", F.lit(1).alias("quality")).union(spark.createDataFrame([(None, 1)], "doc_id long, quality int")))
    assert len({b for _, _, b in one.rows}) == 1


def test_scratch_tables_go_and_others_stay(spark, docs):
    import pathlib

    root = pathlib.Path(common.shared_folder(spark).removeprefix("file://"), "skeinwork")
    before = set(root.iterdir()) if root.exists() else set()
    with common.scratch():
        inside = sorted(map(tuple, near_dup.near_duplicates(docs).collect()))
    assert set(root.iterdir()) == before
    out = near_dup.near_duplicates(docs)
    assert sorted(map(tuple, out.collect())) == inside and set(root.iterdir()) > before


def test_production_bands_reject_noise_and_repeats_and_keep_prose(spark, sf_dir):
    import base64

    r = random.Random(5)
    labels = {x.doc_id for x in spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").collect()}
    good = [x for x in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() if x.doc_id in labels and len((x.text or "").encode()) >= 256]
    assert {x.lang for x in good} == {"en", "de", "es", "fr"}
    long = {lang: "\n".join(x.text for x in good if x.lang == lang) for lang in ("en", "de", "es", "fr")}

    def dump(n):
        return base64.encodebytes(r.randbytes(n)).decode()[:n]

    def letters(n):
        return " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(r.randrange(4, 30))) for _ in range(n // 10))[:n]

    bad = [f(n) for n in (4000, 20_000, 100_000) for f in (dump, letters)] + [letters(1200)]
    for t in long.values():
        bad += [t[: n - int(s * n)] + "\n" + dump(int(s * n)) for n in (3000, 8000) for s in (0.34, 0.5)]
        bad += [t[:6000] + t[:3000], t[:3000] + t[:1500]]  # a third is said twice
    bad.append(long["en"][:20_000] + dump(4500))
    rows = [(k, t) for k, t in enumerate(bad)] + [(10_000 + k, x.text) for k, x in enumerate(good)]
    got = quality.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert not [x for x in got if x.doc_id < 10_000 and x.kept]
    assert sum(not x.base_failed for x in got if x.doc_id < 10_000) > 20
    assert not [x for x in got if x.doc_id >= 10_000 and not x.kept and not x.base_failed]


# 4


def multiset(t):
    w = re.findall(SPLIT, t or "")
    return collections.Counter(zip(*[w[k:] for k in range(5)], strict=False)) if len(w) >= 5 else collections.Counter([tuple(w)] if w else [])


def components(ids, linked):
    par = {i: i for i in ids}

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        par[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def weighted(a, b):
    inner = sum((a & b).values())
    return inner / (sum(a.values()) + sum(b.values()) - inner) if a and b else 0


def test_near_duplicates(spark, docs, texts, empty):
    sets = {i: multiset(t) for i, t in texts}
    ids = list(sets)
    want = components(ids, [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if weighted(sets[a], sets[b]) >= 0.8])
    got = {r.doc_id: r for r in near_dup.near_duplicates(docs).collect()}
    assert {i: r.class_id for i, r in got.items()} == want
    sizes = collections.Counter(want.values())
    assert all(r.class_size == sizes[r.class_id] and r.kept == (i == r.class_id) for i, r in got.items())
    kept = near_dup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(want.values())
    assert near_dup.near_duplicates(empty).count() == 0
    rows = spark.createDataFrame([(None, "a b"), (None, "a b"), (5, "a b"), (5, "a b")], "doc_id long, text string")
    assert sorted((r.doc_id or -1, r.class_id or -1, r.kept) for r in near_dup.near_duplicates(rows).collect()) == [(-1, -1, True), (-1, -1, True), (5, 5, True), (5, 5, True)]


def test_a_group_of_near_copies_is_one_class_without_its_first_text(spark):
    r = random.Random(8)
    base = prose(r, 200, False)
    rows = [(k, edited(r, base, 0.004 if k % 3 else 0.03)) for k in range(60)]
    sets = {i: multiset(t) for i, t in rows}
    ids = [i for i, _ in rows]
    want = components(ids, [(a, b) for a in ids for b in ids if a < b and weighted(sets[a], sets[b]) >= 0.8])
    got = {x.doc_id: x.class_id for x in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def test_bag_minhash_is_unbiased():
    from skeinwork.llm.signatures import bag_minhash

    r = np.random.default_rng(0)
    for seed in range(3):
        e = np.arange(80, dtype=np.uint64) + np.uint64(1000 * seed)
        a = r.integers(0, 12, 80)
        b = np.maximum(0, a + r.integers(-3, 4, 80))
        row = np.r_[np.zeros((a > 0).sum(), int), np.ones((b > 0).sum(), int)]
        s = bag_minhash(row, np.r_[e[a > 0], e[b > 0]], np.r_[a[a > 0], b[b > 0]], 2, 20_000)
        assert abs((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.015


# 5


def test_token_counts(docs, texts, empty):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    got = {r.doc_id: r for r in token_counts.token_counts(docs, path, limit=100).collect()}
    for i, t in texts:
        n = len(sp.encode(t or ""))
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 100)
    assert token_counts.token_counts(empty, path).count() == 0


def test_tokens_of_odd_texts():
    import pyarrow as pa
    from tokenizers import Tokenizer

    from skeinwork.llm.tokens import piece_bpe_counts, sentence_pieces, word_bpe_ids

    r = random.Random(1)
    parts = ["a", "b", "Word", " ", "  ", "\n", "\t", "é", "É", "▁", "<|endoftext|>", "<|StartOfText|>", "<s>", "'s", "'", "…", "中", "́", "🙂", "0", "\x0b", "\x85", "Σ", "İ", "token=", "the", " of", ".", ",", "é.", "A,", "<0x0A>"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(25))) for _ in range(1500)] + ["", " ", "  ", "a ", "a  ", " a", None]
    a, b = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
    assert piece_bpe_counts(pa.array(texts), a).tolist() == [len(sentence_pieces(a).encode(t or "")) for t in texts]
    ids, bounds = word_bpe_ids(pa.array(texts), b)
    t49 = Tokenizer.from_file(b)
    assert [ids[x:y].tolist() for x, y in zip(bounds[:-1], bounds[1:], strict=True)] == [t49.encode(t or "", add_special_tokens=False).ids for t in texts]


# 6


def test_range_coder_round_trips():
    from skeinwork.llm.range_coder import decode, encode

    r = np.random.default_rng(1)
    for block in (64, 4096):
        for n in (0, 1, 15, 16, 17, 63, 64, 65, 4095, 4097, 9000):
            for ids in (r.integers(0, 65_535, n), r.zipf(1.3, n) % 49_408, np.full(n, 7), np.resize([1, 2, 3, 49_407], n)):
                ids = ids.astype(np.uint16)
                assert (decode(encode(ids, block), n, block) == ids).all()
    text = np.resize(r.integers(0, 49_408, 300), 40_000).astype(np.uint16)
    assert sum(map(len, encode(text))) < 0.35 * 2 * len(text)


def test_range_coder_takes_few_steps():
    """A block's strands are coded side by side, so that numpy is called far less often than once for each id."""
    import sys

    from skeinwork.llm.range_coder import decode, encode

    ids, calls = (np.random.default_rng(2).zipf(1.3, 4096) % 49_408).astype(np.uint16), 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event == "c_call"

    sys.setprofile(count)
    try:
        back = decode(encode(ids), len(ids))
    finally:
        sys.setprofile(None)
    assert (back == ids).all() and calls < 5 * len(ids)


def test_range_coder_strands_write_one_slot():
    """Strands that meet one context in one step, blocks above 4,096 ids, and blocks that no number of strands divides."""
    from skeinwork.llm.range_coder import decode, encode

    r = np.random.default_rng(3)
    for block, n in ((4096, 3 * 4096 + 5), (8192, 20_000), (65_536, 70_000), (100, 1234), (33, 500), (1, 9)):
        for ids in (r.integers(0, 3, n), np.repeat(r.integers(0, 49_408, n // 5 + 1), 5)[:n], np.full(n, 65_534)):
            ids = ids.astype(np.uint16)
            assert (decode(encode(ids, block), n, block) == ids).all()
    for block in (0, 65_537):
        with pytest.raises(ValueError, match="can be coded"):
            encode(ids, block)


def test_plain_words_by_the_model_alone():
    """Words of a to z meet only the library's BPE model; their ids, and all others', are those of the whole tokenizer."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    whole, r = Tokenizer.from_file(path), random.Random(9)
    plain = ["".join(r.choice("onreihwlzqx") for _ in range(r.randrange(1, 24))) for _ in range(1500)] + ["a", "startoftext", "z" * 3000]
    other = ["Äpfel", "naïve", "ſ", "日本語", "x1y2", "don't", "'s", "ÀB", "a_b", "9", "e\u0301t\u00e9", "K", "\u2028x"]
    for words in (plain, other, plain + other, plain[:1], other[:1]):
        flat, size = tokens._word_bpe(path, pa.array([w.encode() for w in words], pa.large_binary()))
        ends = np.cumsum(size)
        assert [flat[b - n : b].tolist() for b, n in zip(ends, size, strict=True)] == [whole.encode(w, add_special_tokens=False).ids for w in words]


def test_token_files(spark, docs, texts, empty, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    t49, at, want = Tokenizer.from_file(path), 0, {}
    for i, t in sorted(texts, key=lambda x: x[0]):
        ids = [*t49.encode(t or "", add_special_tokens=False).ids, 1]
        want[i] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    token_files.write_token_files(docs, f"{tmp_path}/a", path, frame_ids=3000, block=256)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.read_token_files(spark, f"{tmp_path}/a").collect()} == want
    token_files.write_token_files(empty, f"{tmp_path}/b", path)
    assert token_files.read_token_files(spark, f"{tmp_path}/b").count() == 0
    frames = spark.read.parquet(f"{tmp_path}/a")
    frames.withColumn("sums", F.transform("sums", lambda x: x + 1)).write.parquet(f"{tmp_path}/c")
    with pytest.raises(Exception, match="wrong checksum"):
        token_files.read_token_files(spark, f"{tmp_path}/c").collect()


# 7


def test_mixing(spark, empty):
    r = random.Random(4)
    rows = [(k, prose(r, r.randrange(1, 40)), s) for k, s in enumerate(["hot"] * 300 + ["a"] * 60 + ["b"] * 20 + [None] * 30 + ["none"] * 3)]
    rows = [(i, None if s == "none" else t, s) for i, t, s in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    tokens = collections.Counter()
    for _, t, s in rows:
        tokens[s] += len(re.findall(SPLIT, t or ""))
    total = sum(tokens.values())
    longest = max(len(re.findall(SPLIT, t or "")) for _, t, _ in rows)
    got = mixing.mix(df, entropy=0.9, repeats=3.0, blocks=16).collect()
    used, weight = collections.Counter(), {}
    for x in got:
        used[x.source] += x.n_tokens
        weight[x.source] = x.weight
    assert "none" not in used and abs(sum(weight.values()) - 1) < 1e-9
    for s, w in weight.items():
        assert 0 <= int(total * w) - used[s] < longest and total * w <= 3.001 * tokens[s]
    times = collections.Counter((x.doc_id, x.epoch) for x in got)
    assert max(times.values()) == 1 and max(x.epoch for x in got) >= 1
    p = np.array([tokens[s] / total for s in weight])
    a = np.log(list(weight.values()))
    slope = np.polyfit(np.log(p), a, 1)[0]  # weights are a power of the shares
    assert np.allclose(a, slope * np.log(p) + np.mean(a - slope * np.log(p)), atol=1e-6) and 0 <= slope < 1
    assert mixing.mix(empty).count() == 0
    out = mixing.mixed_documents(df, entropy=0.9, repeats=3.0, blocks=16)
    assert out.columns == df.columns and out.count() == len(got)
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    counted = {x.doc_id: x.n_tokens for x in mixing.mix(df, blocks=16, model_path=path).collect()}
    assert counted and all(n == len(model.encode(rows[i][1] or "")) for i, n in counted.items())


def signed_hash(*values):
    """Spark's hash of a row of longs and ints (Python's int and numpy's int32)."""
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(int(v).to_bytes(4 if isinstance(v, np.int32) else 8, "little", signed=True), h)
    return h - (1 << 64) if h >> 63 else h


def mixed_by_hand(rows, weights, blocks, seed=7):
    """(doc_id, epoch, block_rank) of each use: whole permutations of blocks, then what fits the rest of the quota."""
    i32 = np.int32
    size = lambda t: len(re.findall(SPLIT, t or ""))
    budget, out = sum(size(t) for _, t, _ in rows), []
    for source, weight in weights.items():
        own = collections.defaultdict(list)
        for i, t, s in rows:
            if s == source:
                own[signed_hash(i, i32(seed)) % blocks].append((signed_hash(i, i32(seed + 2)), i, size(t)))
        tokens = sum(n for b in own.values() for _, _, n in b)
        left, epoch = int(np.floor(budget * weight)), 0
        while left >= 0:
            most, before = min(left, tokens), 0
            for rank, b in enumerate(sorted(own, key=lambda b: (signed_hash(epoch, i32(b), i32(seed + 1)), b)), 1):
                upto = 0
                for _, i, n in sorted(own[b]) if most > before else []:
                    upto += n
                    if upto <= most - before:
                        out.append((i, epoch, rank))
                before += upto if most > before else sum(n for *_, n in own[b])
            left, epoch = left - tokens, epoch + 1
    return collections.Counter(out)


def test_mixing_uses_the_rows_of_the_permutations(spark):
    r = random.Random(9)
    rows = [(k * 7, prose(r, r.randrange(1, 30)), s) for k, s in enumerate(["hot"] * 200 + ["a"] * 50 + ["b"] * 12 + [None] * 25)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for blocks, entropy in ((8, 0.97), (32, 0.8)):
        got = mixing.mix(df, entropy=entropy, blocks=blocks).collect()
        assert collections.Counter((x.doc_id, x.epoch, x.block_rank) for x in got) == mixed_by_hand(rows, {x.source: x.weight for x in got}, blocks)


def test_mixed_documents_come_in_the_order_of_the_mix(spark):
    r = random.Random(10)
    rows = [(k, prose(r, 10, False), s) for k, s in enumerate(["hot"] * 150 + ["a"] * 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    place = collections.defaultdict(list)
    for x in mixing.mix(df, blocks=8).collect():
        place[x.doc_id].append((x.epoch, x.block_rank))
    out = [x.doc_id for x in mixing.mixed_documents(df, blocks=8).collect()]
    at = [sorted(place[i]) for i in out]
    seen = collections.Counter()
    order = []
    for i, p in zip(out, at, strict=True):
        order.append(p[seen[i]])
        seen[i] += 1
    assert order == sorted(order) and seen == {i: len(p) for i, p in place.items()}


def test_blocks_follow_the_greatest_source(spark):
    rows = [(k, "word " * (k % 7), "hot" if k % 3 else None) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    most = sum(k % 7 for k in range(300) if k % 3)
    got, want = (sorted(map(str, mixing.mix(df, **how).collect())) for how in ({"blocks": 2, "block_tokens": 40}, {"blocks": -(-most // 40)}))
    assert got == want and len({x.split("block=")[1].split(",")[0] for x in got}) > 2
    assert sorted(map(str, mixing.mix(df, blocks=64, block_tokens=10**9).collect())) == sorted(map(str, mixing.mix(df, blocks=64).collect()))


def test_exponent_meets_entropy_or_the_repetition_limit(spark):
    p = [0.7, 0.2, 0.07, 0.03]
    shares = spark.createDataFrame([(str(k), x) for k, x in enumerate(p)], "key string, p double")

    def measure(a):
        w = np.array(p) ** a
        w /= w.sum()
        return -(w * np.log(w)).sum() / np.log(4), (w / np.array(p)).max()

    a = mixing.bisect_exponent(shares, 4, 1.0, 0.9, 100.0)
    assert abs(measure(a)[0] - 0.9) < 1e-4
    b = mixing.bisect_exponent(shares, 4, 1.0, 1.0, 2.0)
    assert abs(measure(b)[1] - 2.0) < 1e-3 and measure(b)[1] <= 2.0 + 1e-6
    assert mixing.bisect_exponent(shares, 4, 1.0, 0.1, 100.0) == 1.0


# 8


def check_packing(rows, ids_of, limits):
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for x in rows:
        pieces[x.doc_id].append(x)
        sequences[x.sequence_id].append(x)
    for i, ids in ids_of.items():
        at = 0
        for x in sorted(pieces[i], key=lambda x: x.start):
            assert x.start == at and x.doc_tokens == len(ids) and x.ids_crc32 == zlib.crc32(np.array(ids[at : at + x.length], "<u4").tobytes())
            at += x.length
        assert at == len(ids)
    padding = 0
    for s in sequences.values():
        at = 0
        for x in sorted(s, key=lambda x: x.offset):
            assert x.offset == at
            at += x.length
        assert at <= limits.tokens and len(s) <= limits.segments and sum(x.n_loss for x in s) <= limits.loss
        padding += 0 if at & (at - 1) == 0 else limits.tokens - at
    return padding


def test_packing(docs, texts, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    t49 = Tokenizer.from_file(path)
    ids_of = {i: [*t49.encode(t or "", add_special_tokens=False).ids, 2] for i, t in texts}
    total = sum(map(len, ids_of.values()))
    assert check_packing(packing.pack(docs, path).collect(), ids_of, packing.Limits()) <= 0.02 * total
    tight = packing.Limits(tokens=512, segments=4, loss=300, cut=8)
    check_packing(packing.pack(docs, path, limits=tight).collect(), ids_of, tight)
    with_prompt = docs.withColumn("prompt", F.lit(50))
    rows = packing.pack(with_prompt, path, limits=tight, free_col="prompt").collect()
    check_packing(rows, ids_of, tight)
    assert sum(x.n_loss for x in rows) == sum(max(0, len(v) - 50) for v in ids_of.values())
    assert packing.pack(empty, path).count() == 0


def check_choices(sequences, sizes, frees, limits):
    """Each piece is one of those that a look at every waiting piece finds best (equal ones may go in any order)."""
    wait = {k: [0, n, f] for k, (n, f) in enumerate(zip(sizes, frees, strict=True)) if n}
    bears = lambda p, end: max(0, end - max(p[0], p[2]))
    for sequence in sequences:
        left = [limits.tokens, limits.segments, limits.loss]

        def score(p):
            return (p[1] - p[0]) * (left[0] / limits.tokens**2) + bears(p, p[1]) * (left[2] / limits.loss**2)  # noqa: B023

        for who, begin, end in sequence:
            p = wait[who]
            fit = [q for q in wait.values() if q[1] - q[0] <= left[0] and bears(q, q[1]) <= left[2]]
            assert begin == p[0] and left[1] >= 1 and (fit or begin == end or left[0] >= limits.cut or end - begin <= limits.tokens)
            assert score(p) >= max(map(score, fit or wait.values())) - 1e-12 and (not fit or any(p is q for q in fit))
            assert end == (p[1] if fit else p[0] + min(p[1] - p[0], left[0], left[2] + max(0, p[2] - p[0])))
            left = [left[0] - (end - begin), left[1] - 1, left[2] - bears(p, end)]
            p[0] = end
            if p[0] == p[1]:
                del wait[who]
        fits = any(q[1] - q[0] <= left[0] and bears(q, q[1]) <= left[2] for q in wait.values())
        assert not wait or left[1] < 1 or left[0] < 1 or (not fits and (left[0] < limits.cut or left[2] < 1))
    assert not wait


def test_pool_takes_what_a_look_at_every_piece_takes():
    r = random.Random(4)
    for limits in (packing.Limits(100, 6, 100, 4), packing.Limits(64, 5, 40, 8), packing.Limits(50, 64, 20, 3)):
        for _ in range(15):
            sizes = [r.choice([1, 2, 7, 30, 55, 140, r.randrange(1, 90)]) for _ in range(r.randrange(1, 40))]
            frees = [r.choice([1, 1, 10]) for _ in sizes]
            pool = packing.Pool(limits)
            pool.add(np.arange(len(sizes)), np.array(sizes), np.array(frees))
            check_choices(list(pool.fill(0)), sizes, frees, limits)
            assert not pool.tokens


def test_short_texts_are_packed_without_padding_and_in_time(spark):
    import time

    path = public_tokenizers.path("word_bpe_49k.json")
    few = spark.createDataFrame([(k, f"short text {k}") for k in range(4000)], "doc_id long, text string").coalesce(1)
    rows = packing.pack(few, path).collect()
    sequences = collections.Counter()
    for x in rows:
        sequences[x.sequence_id] += x.length
    tokens = sum(sequences.values())
    assert sum(0 if n & (n - 1) == 0 else 4096 - n for n in sequences.values()) <= 0.02 * tokens
    assert sum(x.doc_tokens for x in rows if x.start == 0) == tokens
    pool, r = packing.Pool(packing.Limits()), random.Random(2)
    pool.add(np.arange(100_000), np.array([r.randrange(3, 400) for _ in range(100_000)]), np.ones(100_000, np.int64))
    began, want = time.time(), pool.tokens
    assert sum(b - a for s in pool.fill(0) for _, a, b in s) == want and time.time() - began < 60


# 9


def removed(texts, length):
    seen, out = set(), {}
    for i, t in sorted((i, t or "") for i, t in texts):
        b = t.encode()
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - length + 1):
            k = b[p : p + length]
            if k in seen:
                gone[p : p + length] = True
            seen.add(k)
        gone = gone[: len(b)]
        spans = int(np.diff(np.r_[0, gone.astype(int)]).clip(0).sum())
        out[i] = (len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest())
    return out


@pytest.mark.parametrize("segment, large", [(prefix_free.SEGMENT, 20_000), (700, 3)])
def test_repeated_bytes(spark, docs, texts, empty, segment, large):
    r = random.Random(3)
    base = ["".join(r.choice("ab cé") for _ in range(500)) for _ in range(4)]
    more = []
    for k in range(30):
        parts = []
        for _ in range(5):
            b, a = r.choice(base), r.randrange(400)
            parts.append(r.choice([b[a : a + r.randrange(300)], "".join(r.choice("xyz") for _ in range(r.randrange(50))), "ab" * r.randrange(120)]))
        more.append((1000 + 7 * k, "".join(parts)))
    for rows in (texts, more):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in prefix_free.removed_bytes(df, segment=segment, large=large).collect()}
        assert got == removed(rows, 100)
    # an id with several texts: each is a document, in the order of their hashes; equal rows are one document
    odd = [(i, t) for i, t in more[:8]] + [(more[3][0], more[9][1]), (more[3][0], more[3][1]), (more[5][0], more[10][1]), (more[5][0], more[10][1]), (None, more[3][1]), (None, None)]
    df = spark.createDataFrame(odd, "doc_id long, text string")
    known = sorted((x.doc_id, x.mark, x.text) for x in df.where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("mark"), "text").distinct().collect())
    each = removed([(k, t) for k, (_, _, t) in enumerate(known)], 100)
    want = [(i, *each[next(k for k, x in enumerate(known) if (x[0], x[2]) == (i, t))]) for i, t in odd if i is not None]
    want += [(0, len(t.encode()), 0, 0, hashlib.sha256(t.encode()).hexdigest()) for t in (more[3][1], "")]
    assert sorted((x.doc_id or 0, x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in prefix_free.removed_bytes(df, segment=segment, large=large).collect()) == sorted(want)
    if large > 3:
        assert prefix_free.removed_bytes(docs).count() == len(texts) and prefix_free.removed_bytes(empty).count() == 0


# 10


def mixed(x):
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> shift)) * factor & 2**64 - 1
    return x ^ (x >> 31)


def removed_passages(rows, least=0.8, size=20, span=28):
    """All pairs of lines and of passages at content-defined places, compared one by one: {doc_id: (spans, source ids)}."""
    units = []
    for i, t in rows:
        t = t or ""
        words = list(re.finditer(SPLIT, t))
        five = []
        for k in range(len(words)):
            h = 0
            for j in range(5):
                h = (h * 0x9E3779B97F4A7C15 + xxhash.xxh3_64_intdigest(words[k + j].group()) if k + j < len(words) else h) & 2**64 - 1
            five.append(mixed(h) >> 24)
        starts = range(len(words) - size + 1)
        low = {k for k in starts if all((five[k], k) <= (five[j], j) for j in range(max(0, k - 2), min(len(starts), k + 3)))}
        tries = [[k for k in starts[a : a + span] if k in low] for a in range(max(1, len(starts) - span + 1))]
        places = {min(x, key=lambda k: (five[k], k)) for x in tries if x}
        lines = collections.defaultdict(list)
        for k, w in enumerate(words):
            lines[t.count("\n", 0, w.start())].append(k)
        found = [(0, x[0], x[-1] + 1) for x in lines.values() if len(x) >= size] + [(1, a, a + size) for a in places]
        text = [w.group() for w in words]
        units += [((i, a, kind), b, {tuple(text[k : k + 5]) for k in range(a, b - 4)}, words) for kind, a, b in found]
    units.sort(key=lambda u: u[0])
    linked = [(u[0], v[0]) for k, u in enumerate(units) for v in units[k + 1 :] if u[0][2] == v[0][2] and len(u[2] & v[2]) >= least * len(u[2] | v[2])]
    first, at = components([u[0] for u in units], linked), {u[0]: u for u in units}
    out = {i: (set(), set()) for i, _ in rows}
    for key, stays in first.items():
        if key == stays:
            continue
        (i, a, _), b, _, words = at[key]
        out[i][0].add((words[a].start(), words[b - 1].end()))
        out[i][1].add(stays[0])
    for i, (spans, sources) in out.items():
        joined = []
        for a, b in sorted(spans):
            if joined and a <= joined[-1][1] + 1:
                joined[-1][1] = max(joined[-1][1], b)
            else:
                joined.append([a, b])
        out[i] = (joined, sorted(sources))
    return out


def passage_rows(seed=5):
    """Passages of 51 words and more within lines, over several lines, edited, and beside clean text."""
    r = random.Random(seed)
    passages = [prose(r, n, n % 2 == 0) for n in (51, 54, 70, 90)]
    out = []
    for k in range(24):
        before, after = prose(r, r.randrange(60), False), prose(r, r.randrange(1, 60), k % 3 == 0)
        p = passages[k % 4]
        out.append((1000 + k, before + (edited(r, p, 0.02) if k > 19 else p) + after))
    return out


def test_paragraphs(spark, docs, texts, empty):
    for rows, df in ((texts, docs), (passage_rows(), spark.createDataFrame(passage_rows(), "doc_id long, text string"))):
        want = removed_passages(rows)
        gone = paragraphs.repeated_paragraphs(df, passage_bands=(12, 2))  # enough bands to find all pairs
        got = {r.doc_id: r for r in paragraphs.summary(df, gone).collect()}
        assert len(got) == len(rows)
        for i, (spans, sources) in want.items():
            assert (got[i].spans, got[i].n_removed, got[i].source_ids) == (",".join(f"{a}:{b}" for a, b in spans), len(spans), sources)
            assert got[i].removed_chars == sum(b - a for a, b in spans)
        clean = paragraphs.without_paragraphs(df, gone)
        assert clean.schema == df.schema
        left = {r.doc_id: r.text for r in clean.collect()}
        for i, t in rows:
            for a, b in reversed(want[i][0]):
                t = t[:a] + t[b:]
            assert left[i] == t
    assert [i for i, t in rows if i < 1020 and not got[i].n_removed] == [1000, 1001, 1002, 1003]
    none = paragraphs.repeated_paragraphs(empty)
    assert none.count() == 0 and paragraphs.summary(empty, none).count() == 0


def test_the_registered_bands_find_edited_passages(spark):
    """The query's own bands against all pairs: nothing more goes, and nearly all of what is not verbatim too."""
    r = random.Random(17)
    rows, k = [], 0
    for n in (51, 70, 120):
        for _ in range(20):
            passage = " ".join(f"w{r.randrange(10**6)}" for _ in range(n))
            for share in (0.0, 0.02, 0.05):
                rows.append((k, " ".join(f"z{r.randrange(10**6)}" for _ in range(r.randrange(1, 60))) + " " + edited(r, passage, share) + " " + " ".join(f"y{r.randrange(10**6)}" for _ in range(r.randrange(1, 60)))))
                k += 1
    # pairs of sets that differ at an end alone: never equal, similarity 0.88
    for _ in range(150):
        words = [f"v{r.randrange(10**6)}" for _ in range(20)]
        rows += [(k, " ".join(words)), (k + 1, " ".join([f"u{r.randrange(10**6)}", *words[1:]]))]
        k += 2
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lines = {"line_bands": (1, 40)}  # lines share no band unless they are equal, so passages are judged by themselves
    got = {x.doc_id: x.spans for x in paragraphs.summary(df, paragraphs.repeated_paragraphs(df, **lines)).collect()}
    want = removed_passages(rows)
    places = lambda spans: {p for a, b in spans for p in range(a, b)}
    hit = wanted = 0
    for i, _ in rows:
        have = places([tuple(map(int, x.split(":"))) for x in got[i].split(",") if x])
        due = places(want[i][0])
        assert have <= due
        hit, wanted = hit + len(have), wanted + len(due)
    pairs = [i for i, _ in rows[180:] if want[i][0]]
    found = sum(bool(got[i]) for i in pairs)
    assert len(pairs) == 150 and found >= 0.9 * len(pairs) and hit >= 0.95 * wanted, (found, hit, wanted)


def test_passages_alike_but_for_an_end_word_are_all_found(spark):
    """Similarity 0.88, each pair by itself: the first word differs, or the last one, or one begins a word later."""
    r = random.Random(23)
    rows = []
    for k in range(0, 1200, 2):
        words = [f"v{r.randrange(10**6)}" for _ in range(20)]
        rows += [(k, " ".join(words)), (k + 1, " ".join([["u", *words[1:]], [*words[:-1], "u"], [*words[1:], "u"]][k // 2 % 3]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    gone = paragraphs.repeated_paragraphs(df, line_bands=(1, 40))  # few lines share a band unless they are equal
    assert sorted({(x.source_id, x.doc_id) for x in gone.collect()}) == [(k, k + 1) for k in range(0, 1200, 2)]


def test_passages_that_repeat_no_three_words_meet_by_runs():
    """Where runs are said to decide, each pair of enough similarity has one in common; words of few kinds, turned and edited."""
    r = random.Random(3)
    rows = []
    for k in range(3000):
        kinds = r.choice((1, 2, 3, 5, 8, 20))
        if k % 3:  # a period, so that one set of shingles can be begun anywhere
            period = [r.randrange(kinds) for _ in range(r.randrange(1, 21))]
            words = (period * 42)[:42]
        else:
            words = [r.randrange(kinds) for _ in range(42)]
        at = r.randrange(20)
        rows.append(words[at : at + 20])
        rows.append(words[(b := r.randrange(20)) : b + 20])
        other = list(rows[-2])
        other[r.choice((0, 0, 1, 10, 18, 19, 19))] = r.randrange(kinds + 1)
        rows.append(other)
    hashes = np.array([[xxhash.xxh3_64_intdigest(str(w)) for w in x] for x in rows], np.uint64)
    runs, repeats = paragraphs._runs(hashes), paragraphs._repeats(hashes)
    assert paragraphs._runs_decide(20, 0.8) and not paragraphs._runs_decide(20, 0.7) and not paragraphs._runs_decide(40, 0.8)
    assert [bool(x) for x in repeats] == [len({tuple(x[k : k + 3]) for k in range(18)}) < 18 for x in rows]
    sets = [{tuple(x[k : k + 5]) for k in range(16)} for x in rows]
    close = unequal = 0
    for k in range(0, len(rows), 3):
        for i, j in ((k, k + 1), (k, k + 2), (k + 1, k + 2)):
            alike = len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
            if alike and not (repeats[i] and repeats[j]):
                close, unequal = close + 1, unequal + (rows[i] != rows[j])
                assert set(runs[i]) & set(runs[j]), (rows[i], rows[j])
    assert unequal > 100, (close, unequal)


def test_hot_and_cold_keys_are_shared_alike(spark):
    """Rows of keys with several rows, whether counted where they lie or, in the parts that hold a hot key, joined."""
    keys = [7] * 3000 + [7 + links.PARTS, -5, -5, 9 - links.PARTS] + [*range(1000, 2500), *range(2000, 2700)]
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key long, id long")
    tables = links.shared_rows(rows.select("key"), rows.where("key >= 0"), rows.where("key < 0"))
    got = sorted((x.id, x.key, x.n) for t in tables for x in t.collect())
    count = collections.Counter(keys)
    assert got == [(i, k, count[k]) for i, k in enumerate(keys) if count[k] > 1]


def test_links_that_come_later_join_components(spark):
    r = random.Random(12)
    pairs = [tuple(sorted(r.sample(range(120), 2))) for _ in range(90)]
    early, late = pairs[:60], pairs[60:]
    made = lambda x: spark.createDataFrame(x, "a long, b long")
    got = {x.id: x.label for x in links.joined(links.components(made(early)), made(late)).collect()}
    ids = sorted({i for p in pairs for i in p})
    assert got == components(ids, pairs)


def test_a_passage_of_51_words_is_found_wherever_it_stands(spark):
    r = random.Random(8)
    rows = []
    for k in range(60):
        passage = " ".join(f"w{r.randrange(10**6)}" for _ in range(51))
        for j in range(2):
            rows.append((2 * k + j, " ".join(f"z{r.randrange(10**6)}" for _ in range(r.randrange(150))) + " " + passage + " " + " ".join(f"y{r.randrange(10**6)}" for _ in range(r.randrange(150)))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x for x in paragraphs.summary(df, paragraphs.repeated_paragraphs(df)).collect()}
    for i, t in rows:
        at = re.search(r"w.*w\d+", t)
        spans = [tuple(map(int, x.split(":"))) for x in got[i].spans.split(",") if x]
        assert bool(spans) == bool(i % 2)
        for a, b in spans:  # an end word beside the passage goes too where the paragraph that has it is 0.88 alike
            assert at.start() - 8 <= a and b <= at.end() + 8 and len(t[a:b].split()) >= 20


def test_paragraphs_of_repeated_and_missing_ids(spark):
    r = random.Random(4)
    passage, own = prose(r, 70, False), prose(r, 30, False)
    rows = [(1, own + passage), (1, own + passage), (1, passage + prose(r, 40, False)), (None, passage), (None, None), (2, None), (3, ""), (4, prose(r, 10, False) + passage)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    gone = paragraphs.repeated_paragraphs(df)
    got = sorted((x.doc_id or 0, x.n_removed, x.removed_chars) for x in paragraphs.summary(df, gone).collect())
    assert got.count((0, 0, 0)) == 2 and (2, 0, 0) in got and (3, 0, 0) in got and got[-1][:2] == (4, 1)
    # equal rows of one id are one document; one of its two texts is first, and the other (or both equal rows) loses the passage
    assert [x[1] for x in got if x[0] == 1] in ([0, 0, 1], [0, 1, 1])
    assert paragraphs.without_paragraphs(df, gone).count() == len(rows)


# all


def test_batches_hold_about_their_bytes():
    import pyarrow as pa

    rows = [("x" * n,) for n in (1, 5, 100, 3, 3, 3, 90, 0, 0, 2)]
    batch = pa.RecordBatch.from_pydict({"text": [x for (x,) in rows]})
    out = list(batches_by_bytes(iter([batch, batch.slice(0, 0), batch]), 10))
    assert [x for t in out for x in t["text"].to_pylist()] == [x for (x,) in rows] * 2
    assert all(t.num_rows == 1 or sum(map(len, t["text"].to_pylist())) <= 10 for t in out)


def test_stages_keep_rows_apart_that_share_an_id_or_have_none(spark):
    r = random.Random(21)
    a, b, c, d = (prose(r, 80, False) for _ in range(4))
    schema = "doc_id long, text string, source string"
    # exact: equal rows under one id, equal texts without an id, two texts under one id
    rows = [(4, a, "x"), (4, a, "x"), (4, b, "x"), (9, a, "y"), (None, c, "x"), (None, c, "x"), (None, a, "x"), (None, d, "y"), (2, d, "x"), (2, d + " ", "x")]
    got = exact_dedup.drop_exact_duplicates(spark.createDataFrame(rows, schema))
    assert got.columns == ["doc_id", "text", "source"]
    assert sorted(((x.doc_id or 0), x.text) for x in got.collect()) == sorted([(4, a), (4, b), (0, c), (2, d + " ")])
    # near: near copies under one id, or without one
    rows = [(4, a, "x"), (4, a + " more", "x"), (4, b, "x"), (None, c, "x"), (None, c + " more", "x"), (7, d + " more", "x"), (5, d, "y"), (None, "less " + d, "x")]
    got = [((x.doc_id or 0), x.text) for x in near_dup.drop_near_duplicates(spark.createDataFrame(rows, schema)).collect()]
    assert len(got) == 4 and sorted(i for i, _ in got) == [0, 4, 4, 5] and {(4, b), (5, d)} <= set(got)
    # mixing: as many rows as uses, within the budget, whatever the ids
    rows = [(None if k % 3 == 0 else k // 4, prose(r, 20), "hot" if k % 5 else "rare") for k in range(300)] + [(1000, "again and again", "hot")] * 5
    docs = spark.createDataFrame(rows, schema)
    used, total = mixing.mix(docs, blocks=16).collect(), sum(len(re.findall(SPLIT, t)) for _, t, _ in rows)
    out = [tuple(x) for x in mixing.mixed_documents(docs, blocks=16).collect()]
    assert len(out) == len(used) and sum(len(re.findall(SPLIT, t)) for _, t, _ in out) <= total
    given, times = collections.Counter(rows), collections.Counter(out)
    assert all(n <= 4 * given[x] for x, n in times.items())
    assert len({x.block for x in used if x.doc_id is None}) > 8


def test_pipeline_stages(spark, sf_dir, tmp_path):
    import corpus_pipeline as cp

    docs, seen = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for k, (name, stage) in enumerate(cp.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        if name != "packing":
            assert out.dtypes == docs.dtypes
        seen.append((name, docs, out))
        docs = out
    before, after = seen[0][1].collect(), {r.doc_id for r in seen[0][2].collect()}
    assert after <= {r.doc_id for r in before if len(re.findall(SPLIT, r.text)) >= 50}
    norm = [re.sub(r"[\x20\x09-\x0D]", "", r.text) for r in seen[1][2].collect()]
    assert len(set(norm)) == len(norm) and {re.sub(r"[\x20\x09-\x0D]", "", r.text) for r in seen[1][1].collect()} == set(norm)
    sets = {r.doc_id: multiset(r.text) for r in seen[2][1].collect()}
    ids = sorted(sets)
    index, linked = collections.defaultdict(set), []
    for i in ids:
        near = {j for s in sets[i] for j in index[s]}
        linked += [(j, i) for j in near if weighted(sets[i], sets[j]) >= 0.8]
        for s in sets[i]:
            index[s].add(i)
    assert {r.doc_id for r in seen[2][2].collect()} == set(components(ids, linked).values())
    assert {r.doc_id for r in seen[4][2].collect()} == {r.doc_id for r in seen[3][2].collect()}
    assert cp.run(spark, sf_dir).count() == seen[4][2].count()
