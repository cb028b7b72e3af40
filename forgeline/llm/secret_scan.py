"""Secret scans: fixed rules, and character Markov models of random strings and ordinary identifiers.

Everything here is DataFrame functions; no Python runs on the rows.

The fixed rules find assignments of secrets, access keys and hex strings (``RULES``).  The method adds tokens, runs of at
least TOKEN_CHARS letters, digits and ``+/_=-``, that look random: two first-order models of characters are trained from labelled
samples (token, random), and a token is a secret when its log-likelihood ratio, summed over its neighbouring characters,
reaches MIN_RATIO.  A model's table has a cell for each pair of ALPHABET, so both together stay below 10,000 numbers whatever they learn from.
Ratios are kept in whole thousandths, so sums do not depend on their order.

``labelled_samples`` labels a corpus by the fixed rules: what they found is random, every other token is ordinary.  All
documents count; nothing is sampled.

Positions are code points, end exclusive, and each kind is matched leftmost and without overlap.  Spans of different kinds may overlap; a
token that a fixed rule covers is not listed again.  Null and empty texts have no spans.  Every row is scanned by itself, so
repeated rows and ids repeat their result, and other columns are ignored.  Without random (or ordinary) samples that model is uniform.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgeline.session import scratch_path

# The rules.
_VALUE = r"([A-Za-z0-9+/_.=-]+)"
_KEYWORD = "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
ASSIGN = _KEYWORD + r"""["']?\x20*[:=]\x20*["']?""" + _VALUE
ACCESS = "(AKIA[A-Z0-9]+)"
HEX = "([0-9a-f]+)"
#: kind: pattern, the group whose length counts, and that length
RULES = {"assign": (ASSIGN, 2, 12), "access": (ACCESS, 1, 18), "hex": (HEX, 1, 16)}
#: The same matches, found without trying the short ones: a run of these is matched whole or not at all.
_LONG = {"access": "(AKIA[A-Z0-9]{14,})", "hex": "([0-9a-f]{16,})"}
KINDS = [*RULES, "markov"]

TOKEN_CHARS = 16
TOKEN = f"([A-Za-z0-9+/_=-]{{{TOKEN_CHARS},}})"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
MIN_RATIO = 12_000  # thousandths of a nat
PULL = 10.0
_PART = 256


def _let(value: Column, use) -> Column:
    """use(value), with the value computed once: a lambda's variable is bound, a repeated expression is not."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _running(values: Column, zero: Column, merge) -> Column:
    """What comes before each value, merged; in parts of _PART values, so that long lists stay cheap.  Values: a bound, non-empty list."""
    part = lambda of, i: F.slice(of, i * _PART + 1, F.lit(_PART))
    all_of = lambda of: F.aggregate(of, zero, merge)
    parts = F.sequence(F.lit(0), F.ceil(F.size(values) / _PART).cast("int") - 1)
    begun = _let(F.transform(parts, lambda i: all_of(part(values, i))), lambda totals: F.transform(
        parts, lambda i: F.struct(all_of(F.slice(totals, F.lit(1), i)).alias("before"), part(values, i).alias("own"))))
    return F.flatten(F.transform(begun, lambda p: F.transform(p["own"], lambda _, j: merge(p["before"], all_of(F.slice(p["own"], F.lit(1), j))))))


def _found(text: Column, pattern: str, group: int) -> Column:
    """start, end and value (of the group) of every match, in order; null where there is none."""
    lengths = lambda a: F.transform(a, lambda x: F.char_length(x).cast("long"))
    cut = F.struct(lengths(F.split(text, pattern, -1)).alias("gaps"), lengths(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("sizes"),
                   F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"))

    def spans(c: Column) -> Column:
        gaps = F.slice(c["gaps"], F.lit(1), F.size(c["sizes"]))
        before = _let(F.zip_with(gaps, c["sizes"], lambda g, n: g + n), lambda x: _running(x, F.lit(0).cast("long"), lambda a, n: a + n))
        starts = F.zip_with(before, gaps, lambda b, g: b + g)
        ends = F.zip_with(F.zip_with(starts, c["sizes"], lambda s, n: F.struct(s.alias("start"), (s + n).alias("end"))), c["value"],
                          lambda x, v: F.struct(x["start"].alias("start"), x["end"].alias("end"), v.alias("value")))
        return ends

    return F.when(text.rlike(pattern), _let(cut, spans))


def matches(text: Column, kind: str) -> Column:
    """start, kind (its place in KINDS), end and value of the matches of a fixed rule that are long enough."""
    pattern, group, least = RULES[kind]
    found = _found(text, _LONG.get(kind, pattern), group)
    return F.coalesce(_spans(F.filter(found, lambda r: F.char_length(r["value"]) >= least), kind), F.lit([]).cast(SPANS))


SPANS = "array<struct<start:bigint,kind:int,end:bigint,value:string>>"


def _spans(found: Column, kind: str) -> Column:
    place = F.lit(KINDS.index(kind))
    return F.transform(found, lambda r: F.struct(r["start"].alias("start"), place.alias("kind"), r["end"].alias("end"), r["value"].alias("value")))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, base (spans of the fixed rules) and tokens (spans of all tokens) of every document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    text = F.col("text")
    base = F.concat(*(matches(text, kind) for kind in RULES))
    tokens = F.coalesce(_spans(_found(text, TOKEN, 1), "markov"), F.lit([]).cast(SPANS))
    return docs.select("doc_id", F.array_sort(base).alias("base"), tokens.alias("tokens"))


def _uncovered(tokens: Column, base: Column) -> Column:
    """The tokens that no base span touches: of all spans by start, none of the base before one ends, or after it starts, inside it."""
    none = F.lit(1 << 62).cast("long")
    is_token = lambda r: r["kind"] == len(RULES)

    def left(spans: Column) -> Column:
        ends = F.transform(spans, lambda r: F.when(is_token(r), F.lit(0)).otherwise(r["end"]).cast("long"))
        starts = F.transform(F.reverse(spans), lambda r: F.when(is_token(r), none).otherwise(r["start"]))
        before = _let(ends, lambda x: _running(x, F.lit(0).cast("long"), lambda a, e: F.greatest(a, e)))
        after = F.reverse(_let(starts, lambda x: _running(x, none, lambda a, e: F.least(a, e))))
        free = F.zip_with(F.zip_with(spans, before, lambda r, e: F.when(is_token(r) & (e <= r["start"]), r)), after,
                          lambda r, e: F.when(e >= r["end"], r))
        return F.filter(free, lambda r: r.isNotNull())

    return F.when((F.size(base) == 0) | (F.size(tokens) == 0), tokens).otherwise(_let(F.array_sort(F.concat(base, tokens)), left))


def labelled_samples(scanned: DataFrame) -> DataFrame:
    """token, random: what the fixed rules found, and the tokens they left, of a scanned corpus."""
    random = scanned.select(F.explode("base.value").alias("token"), F.lit(True).alias("random"))
    ordinary = scanned.select(F.explode(_uncovered(F.col("tokens"), F.col("base"))["value"]).alias("token"), F.lit(False).alias("random"))
    return random.unionByName(ordinary)


def _pairs(token: Column) -> Column:
    """The cell of each two neighbouring characters of the alphabet, from 1."""
    codes = F.transform(F.regexp_extract_all(token, F.lit("(?s)(.)"), F.lit(1)), lambda c: F.instr(F.lit(ALPHABET), c))
    cell = lambda a, b: F.when((a > 0) & (b > 0), (a - 1) * len(ALPHABET) + b)
    both = _let(codes, lambda x: F.zip_with(F.slice(x, F.lit(1), F.size(x) - 1), F.slice(x, F.lit(2), F.size(x) - 1), cell))
    return F.when(F.char_length(token) > 1, F.filter(both, lambda x: x.isNotNull())).otherwise(F.lit([]).cast("array<int>"))


def ratios(samples: DataFrame) -> list[int]:
    """ln(P(b | a, random) / P(b | a, ordinary)) of every two characters, in thousandths, rounded down.

    P(b | a) = (n(ab) + PULL * q(b)) / (n(a) + PULL), drawn towards q(b) = (n(b) + 1) / (n + K), the share of b after any character.
    """
    k, label = len(ALPHABET), F.col("random")
    count = (F.count(F.when(label, 1)).alias("r"), F.count(F.when(~label, 1)).alias("o"))
    pairs = samples.select(label.alias("random"), F.explode(_pairs(F.col("token"))).alias("cell")).groupBy("cell").agg(*count)
    cells = samples.sparkSession.range(1, k * k + 1).select(F.col("id").cast("int").alias("cell"))
    table = (cells.join(F.broadcast(pairs), "cell", "left")  # a row for a cell of the fixed alphabet, here and below
             .select("cell", F.floor((F.col("cell") - 1) / k).alias("a"), ((F.col("cell") - 1) % k).alias("b"), *(F.coalesce(c, F.lit(0)).alias(c) for c in ("r", "o"))))
    of = lambda key, end: table.groupBy(*key).agg(F.sum("r").alias(f"r{end}"), F.sum("o").alias(f"o{end}"))
    table = table.join(F.broadcast(of(["a"], "_a")), "a").join(F.broadcast(of(["b"], "_b")), "b").join(F.broadcast(of([], "_all")), F.col("cell") > 0)

    def p(n: str) -> Column:
        share = (F.col(f"{n}_b") + 1).cast("double") / (F.col(f"{n}_all") + k).cast("double")
        return (F.col(n).cast("double") + F.lit(PULL) * share) / (F.col(f"{n}_a").cast("double") + F.lit(PULL))

    got = table.select("cell", F.floor(F.lit(1000.0) * F.ln(p("r") / p("o"))).cast("long").alias("ratio")).collect()
    return [r["ratio"] for r in sorted(got, key=lambda r: r["cell"])]


def log_ratio(token: Column, model: list[int]) -> Column:
    """The log-likelihood ratio of a token, random against ordinary, in thousandths of a nat."""
    cells = F.split(F.lit(",".join(map(str, model))), ",").cast("array<bigint>")
    return F.aggregate(_pairs(token), F.lit(0).cast("long"), lambda s, x: s + F.element_at(cells, x))


def find_secrets(docs: DataFrame, samples: DataFrame | None = None, min_ratio: int = MIN_RATIO) -> DataFrame:
    """doc_id, base and spans (base and random-looking tokens, by start, then kind) of every document.

    samples: token string, random boolean; without them the models learn from the corpus itself, labelled by the fixed rules.
    """
    path = scratch_path(docs.sparkSession, "secrets")
    scan(docs).write.parquet(path)
    scanned = docs.sparkSession.read.parquet(path)
    model = ratios(labelled_samples(scanned) if samples is None else samples)
    added = F.filter(_uncovered(F.col("tokens"), F.col("base")), lambda t: log_ratio(t["value"], model) >= min_ratio)
    return scanned.select("doc_id", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def written(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")
