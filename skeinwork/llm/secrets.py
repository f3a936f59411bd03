"""Secret scans (native): fixed patterns, and character Markov models of random strings against ordinary identifiers."""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text

# The base patterns and their least lengths.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"  # of maximal runs, those of 18 characters or more
HEX = r"[0-9a-f]{16,}"
ASSIGN_LEAST = 12
KINDS = ("assign", "access", "hex", "markov")

#: Strings that the models judge: runs of these characters, at least so long.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
LEAST = 20
#: Of a run, the least stretch; it may lose a character or two of a key at either end.
LEAST_STRETCH = 16
CANDIDATE = r"[A-Za-z0-9+/_=.-]{%d,}" % LEAST
#: Log-likelihood ratio (nats) a random string needs: in all, and for each character.
LEAST_LLR, LEAST_LLR_EACH = 10.0, 0.35
#: Bound of the labelled sample: documents with a label, those of smallest id.
SAMPLE_DOCS = 4000
#: Share of the uniform law in the model of random strings; the labelled samples have the rest.
UNIFORM = 0.5
#: Share of single characters' rates in the model of ordinary strings, for pairs that the samples lack.
SINGLE = 0.3
#: Copies of ALPHABET in a private-use area, which stand for characters that a base span covers.
COVERED = "".join(chr(0xE000 + k) for k in range(len(ALPHABET)))


def labelled_samples(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(s, random): strings for the two models, from at most sample_docs labelled documents (those of smallest id).

    Random are the values that the base patterns find in them, whatever their label. Ordinary is what is left of those
    labelled good: words of six characters or more, and identifiers, each spelled from three words that follow each
    other, in one of six usual ways. Without labels there are no rows; null labels count as not good, null ids are left out.
    """
    chosen = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("__good")).orderBy("doc_id").limit(sample_docs)
    text = id_and_text(docs).join(F.broadcast(chosen), "doc_id").select("text", "__good")
    values = [F.expr(f"filter(regexp_extract_all(text, '{_quoted(p)}', {g}), x -> char_length(x) >= {ASSIGN_LEAST})") for p, g in ((ASSIGN, 2), (ACCESS, 0), (HEX, 0))]
    random = text.select(F.explode(F.array_distinct(F.concat(*values))).alias("s"), F.lit(True).alias("random"))
    left = text.where("__good = 1").select("text")
    for p in (ASSIGN, ACCESS, HEX):
        left = left.select(F.regexp_replace("text", p, " ").alias("text"))
    words = left.select(F.explode(F.regexp_extract_all("text", F.lit(r"[A-Za-z0-9+/_.=-]{6,}"), F.lit(0))).alias("s"))
    plain = left.select(F.regexp_extract_all("text", F.lit("[A-Za-z]{2,}"), F.lit(0)).alias("w"))
    threes = plain.where("size(w) >= 3").select(F.explode(F.expr("transform(sequence(0, size(w) div 3 - 1), k -> transform(slice(w, 3 * k + 1, 3), x -> lower(x)))")).alias("w"))
    a, b, c = (F.col("w")[k] for k in range(3))
    kind = F.pmod(F.xxhash64("w"), F.lit(6))
    named = (
        F.when(kind == 0, F.concat_ws("_", "w"))
        .when(kind == 1, F.concat(a, F.initcap(b), F.initcap(c)))
        .when(kind == 2, F.concat_ws("-", "w"))
        .when(kind == 3, F.concat_ws(".", "w"))
        .when(kind == 4, F.concat_ws("/", a, b, F.concat(c, F.lit("."), F.substring(a, 1, 2))))
        .otherwise(F.upper(F.concat_ws("_", "w")))
    )
    return random.unionByName(words.unionByName(threes.select(named.alias("s"))).select("s", F.lit(False).alias("random")))


def fit(samples: DataFrame) -> list[float]:
    """Log-likelihood ratios of character pairs, random over ordinary, row by row of ALPHABET.

    Rates have add-one smoothing. SINGLE parts of an ordinary one are the second character's own rate, since a bounded
    sample lacks pairs that other ordinary words have. UNIFORM parts of a random one are the uniform law: labelled
    secrets are of few kinds, and those of others are random too. No samples: all ratios are 0. One aggregate over the samples gives at most 2 * len(ALPHABET) ** 2 counts, whatever the samples' size.
    """
    size = len(ALPHABET)
    code = f"transform(split(s, ''), c -> locate(c, '{ALPHABET}'))"
    pairs = samples.select("random", F.expr(code).alias("k")).select("random", F.explode(F.expr("zip_with(slice(k, 1, greatest(size(k) - 1, 0)), slice(k, 2, greatest(size(k) - 1, 0)), (x, y) -> named_struct('x', x, 'y', y))")).alias("p"))
    rows = pairs.where("p.x > 0 and p.y > 0").groupBy("random", "p.x", "p.y").count().collect()
    count = {(r["random"], r["x"], r["y"]): r["count"] for r in rows}
    out = []
    every = sum(count[k] for k in count if not k[0])
    single = [(sum(count.get((False, x, y), 0) for x in range(1, size + 1)) + 1) / (every + size) for y in range(1, size + 1)]
    for x in range(1, size + 1):
        total = {r: sum(count.get((r, x, y), 0) for y in range(1, size + 1)) for r in (True, False)}
        for y in range(1, size + 1):
            rate = {r: (count.get((r, x, y), 0) + 1) / (total[r] + size) for r in (True, False)}
            out.append(math.log((UNIFORM / size + (1 - UNIFORM) * rate[True]) / (SINGLE * single[y - 1] + (1 - SINGLE) * rate[False])))
    return out


_STRUCT = "start:int,kind:int,end:int"
_NONE = f"cast(array() as array<struct<{_STRUCT}>>)"


def _quoted(pattern: str) -> str:
    return pattern.replace("\\", "\\\\").replace("'", "\\'")


#: Running sums are folds over stretches of this many numbers, since an array that grows is copied for each number.
STRETCH = 64


def _running(numbers: str, levels: int = 3) -> str:
    """SQL for the running sums of an array: within stretches, then of the stretches' sums, `levels` deep.

    With three levels the work for n numbers is n * STRETCH, up to STRETCH ** 4 of them.
    """
    x, w, o = (f"{c}{levels}" for c in "xwo")
    fold = "aggregate({}, named_struct('t', 0, 'o', cast(array() as array<int>)), (a, v) -> named_struct('t', a.t + v, 'o', concat(a.o, array(a.t + v))), a -> a.o)".format
    if not levels:
        return fold(numbers)
    stretches = f"transform(sequence(0, cast((size({x}) - 1) div {STRETCH} as int)), k -> {fold(f'slice({x}, k * {STRETCH} + 1, {STRETCH})')})"
    sums = _running(f"transform({w}, b -> b[size(b) - 1])", levels - 1)
    moved = f"flatten(transform({w}, (b, k) -> transform(b, v -> v + if(k = 0, 0, {o}[k - 1]))))"
    long = f"transform(array({stretches}), {w} -> transform(array({sums}), {o} -> {moved})[0])[0]"
    return f"transform(array({numbers}), {x} -> if(size({x}) <= {STRETCH}, {fold(x)}, {long}))[0]"


def _matches(pattern: str, values: int, text: str) -> str:
    """SQL for a text's matches m, their group `values` v, and what is before, between and after them g."""
    p = _quoted(pattern)
    return f"array(named_struct('m', regexp_extract_all({text}, '{p}', 0), 'v', regexp_extract_all({text}, '{p}', {values}), 'g', split({text}, '{p}', -1)))"


def _spans(kind: int, pattern: str, values: int = 0, keep: str = "true", text: str = "text") -> str:
    """SQL for the spans of a pattern's matches, leftmost and non-overlapping, in code points.

    What lies between the matches (split) and the matches themselves give all lengths, and their running sums the ends.
    `keep` judges match i by s.v, the pattern's group `values`.
    """
    ends = _running("zip_with(slice(s.g, 1, size(s.m)), s.m, (x, y) -> char_length(x) + char_length(y))")
    each = f"transform(s.m, (x, i) -> named_struct('start', e[i] - char_length(x), 'kind', {kind}, 'end', e[i]))"
    found = f"transform(array({ends}), e -> filter({each}, (x, i) -> {keep}))[0]"
    return f"if(rlike({text}, '{_quoted(pattern)}'), transform({_matches(pattern, values, text)}, s -> {found})[0], {_NONE})"


def _with_copies(chars: str) -> str:
    """A class of characters that takes their copies of COVERED as well."""
    return f"[{chars}{''.join(COVERED[k] for k, c in enumerate(ALPHABET) if re.fullmatch(f'[{chars}]', c))}]"


def _covered(pattern: str, values: int = 0, keep: str = "true") -> str:
    """SQL for the text with the copies of COVERED in place of the characters of each kept match."""
    both = f"zip_with(slice(s.g, 1, size(s.m)), transform(s.m, (x, i) -> if({keep}, translate(x, '{ALPHABET}', '{COVERED}'), x)), (x, y) -> concat(x, y))"
    return f"if(rlike(text, '{_quoted(pattern)}'), transform({_matches(pattern, values, 'text')}, s -> concat(array_join({both}, ''), s.g[size(s.m)]))[0], text)"


def find_secrets(docs: DataFrame, llr: list[float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, n_markov (long), base_sha256, spans.

    spans is "kind:start:end" of every span by start, then kind (assign, access, hex, markov), comma-joined; code
    points, end exclusive, of the whole match. base_sha256 is SHA-256 of the same over the three pattern kinds. Markov
    spans come from the runs of ALPHABET, each cut at the base spans in it. A piece of LEAST characters or more is a
    span if its character pairs are likelier under the model of random strings by LEAST_LLR in all and LEAST_LLR_EACH a
    pair. If not, its best stretch is one (the greatest sum over the pairs) if it has LEAST_STRETCH characters
    and reaches the same limits: ordinary text beside a key does not hide it. Null or empty text: no spans, counts 0.
    Repeated rows are judged each alone; extra columns are ignored.
    """
    table = ",".join(f"{x:.6g}" for x in llr)
    size = len(ALPHABET)
    kept = f"char_length(s.v[i]) >= {ASSIGN_LEAST}"
    found = id_and_text(docs, id_col, text_col).select(
        "doc_id",
        "text",
        F.expr(_spans(0, ASSIGN, 2, kept)).alias("assign"),
        F.expr(f"if(contains(text, 'AKIA'), {_spans(1, ACCESS)}, {_NONE})").alias("access"),
        F.expr(_spans(2, HEX)).alias("hex"),
    )
    found = found.withColumn("base", F.expr("array_sort(concat(assign, access, hex))"))
    # runs of ALPHABET outside the base spans: copies (none of them the text's own) cover these, and later patterns take the copies, so their spans stay
    covered = found.withColumn("text", F.when(F.col("text").rlike(f"[{COVERED[0]}-{COVERED[-1]}]"), F.translate("text", COVERED, "!" * len(COVERED))).otherwise(F.col("text")))
    access, hexes = "".join(map(_with_copies, (*"AKIA", "A-Z0-9"))) + "{14,}", _with_copies("0-9a-f") + "{16,}"
    for how in (_covered(ASSIGN, 2, kept), _covered(access), _covered(hexes)):
        covered = covered.withColumn("text", F.when(F.size("base") > 0, F.expr(how)).otherwise(F.col("text")))
    found = covered.withColumn("pieces", F.expr(f"zip_with({_spans(3, CANDIDATE)}, regexp_extract_all(text, '{CANDIDATE}', 0), (c, s) -> named_struct('start', c.start, 'end', c.end, 's', s))"))
    code = f"transform(split(c.s, ''), x -> locate(x, '{ALPHABET}'))"
    ratios = f"zip_with(slice(k, 1, size(k) - 1), slice(k, 2, size(k) - 1), (x, y) -> t[(x - 1) * {size} + y - 1])"
    # one fold: the sum of all pairs; the running stretch (begin, sum over the limit) and the best one so far
    fold = (
        f"aggregate({ratios}, named_struct('i', 0, 'all', 0D, 'from', 0, 'run', 0D, 'start', 0, 'end', 0, 'best', 0D), (a, x) -> named_struct("
        "'i', a.i + 1, 'all', a.all + x, "
        f"'from', if(a.run > 0, a.from, a.i), 'run', greatest(a.run, 0D) + x, "
        f"'start', if(greatest(a.run, 0D) + x > a.best, if(a.run > 0, a.from, a.i), a.start), "
        f"'end', if(greatest(a.run, 0D) + x > a.best, a.i + 2, a.end), "
        f"'best', greatest(a.best, greatest(a.run, 0D) + x)))"
    )
    judged = f"transform(pieces, c -> transform(array({code}), k -> named_struct('p', c.start, 'q', c.end, 'f', {fold}))[0])".replace("t[(", f"cast(split('{table}', ',') as array<double>)[(")
    whole = f"j.f.all >= greatest({LEAST_LLR}D, {LEAST_LLR_EACH}D * (j.q - j.p - 1))"
    part = f"j.f.end - j.f.start >= {LEAST_STRETCH} and j.f.best >= greatest({LEAST_LLR}D, {LEAST_LLR_EACH}D * (j.f.end - j.f.start - 1))"
    found = found.withColumn("judged", F.expr(judged))
    spans = f"transform(filter(judged, j -> ({whole}) or ({part})), j -> named_struct('start', if({whole}, j.p, j.p + j.f.start), 'kind', 3, 'end', if({whole}, j.q, j.p + j.f.end)))"
    found = found.withColumn("markov", F.expr(spans))
    names = "array(" + ",".join(f"'{k}'" for k in KINDS) + ")"
    said = "array_join(transform({}, s -> concat({}[s.kind], ':', s.start, ':', s.end)), ',')"
    n = lambda c: F.size(c).cast("long").alias(f"n_{c}")
    return found.select("doc_id", n("assign"), n("access"), n("hex"), n("markov"), F.sha2(F.expr(said.format("base", names)), 256).alias("base_sha256"), F.expr(said.format("array_sort(concat(base, markov))", names)).alias("spans"))
