"""Secret scans: three patterns, and character Markov models for what no pattern names.

Two first-order character models, of random strings and of ordinary identifiers, are
counted from labelled samples; a token whose mean log-likelihood ratio per character
pair exceeds `threshold` is a secret. Tokens are runs of the characters that keys are
written in; only tokens of `shortest` characters or more are judged, whatever characters
they have. Two signs in a row that neither sample has say nothing (their ratio is 0).

DataFrame functions only. The model is one array of ALPHABET x ALPHABET numbers, of fixed
size, and enters the query as a constant.

Defined cases: a null text is empty and has no spans; spans are in code points, end
exclusive, ordered by start and then kind; a token that touches a base span is not
judged again. Without a random sample nothing is judged.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.batches import hashed_sample, quoted

ALPHABET = 128
#: The base patterns (fixed values of the task): kind, pattern with the part to judge as a group, its least length.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
VALUE = r"[A-Za-z0-9+/_.=-]+"
KINDS = ("assign", "access", "hex", "markov")
SPAN = "struct<start: bigint, kind: int, stop: bigint>"
TOKEN = r"[A-Za-z0-9+/_=-]"


@dataclass
class MarkovModel:
    ratios: list[float]  # log P(b | a, random) - log P(b | a, ordinary), at a * ALPHABET + b
    threshold: float
    shortest: int


def _found(text: Column, pattern: str, kind: int, least: Column | None = None) -> Column:
    """Spans of a pattern's leftmost matches that do not overlap.

    Each match is taken together with the gap before it, so that lengths add up to places;
    the end of the text counts as an empty match, or the search would go over the rest again and again.
    """
    both = F.lit(f"(?s)(.*?)({pattern}|\\z)")
    gaps, hits = F.regexp_extract_all(text, both, F.lit(1)), F.regexp_extract_all(text, both, F.lit(2))
    state = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))

    def step(s: Column, x: Column) -> Column:
        start = s["at"] + F.length(x["gaps"])
        stop = start + F.length(x["hits"])
        span = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), stop.alias("stop")))
        good = x["hits"] != "" if least is None else (x["hits"] != "") & least(x["hits"])
        return F.struct(stop.alias("at"), F.when(good, F.concat(s["spans"], span)).otherwise(s["spans"]).alias("spans"))

    return F.aggregate(F.arrays_zip(gaps.alias("gaps"), hits.alias("hits")), state, step)["spans"]


def base_spans(text: Column) -> Column:
    """Spans of the three patterns in order; a row without a hit costs one test per pattern."""
    none = F.array().cast(f"array<{SPAN}>")
    long_value = lambda hit: F.length(F.regexp_extract(hit, f"^{ASSIGN}({VALUE})$", 1)) >= 6
    found = [
        F.when(text.rlike(ASSIGN), _found(text, ASSIGN + VALUE, 0, long_value)).otherwise(none),
        F.when(text.rlike("AKIA[A-Z0-9]{16}"), _found(text, "AKIA[A-Z0-9]{16,}", 1)).otherwise(none),
        F.when(text.rlike("[0-9a-f]{24}"), _found(text, "[0-9a-f]{24,}", 2)).otherwise(none),
    ]
    return F.array_sort(F.concat(*found))


def _pairs(token: Column) -> Column:
    """Places in the model of a token's neighbouring characters; the token is split once, not searched per character."""
    codes = F.transform(F.split(token, ""), F.ascii)
    n = F.greatest(F.length(token) - 1, F.lit(0))
    return F.zip_with(F.slice(codes, 1, n), F.slice(codes, 2, n), lambda a, b: a * ALPHABET + b)


def train(samples: DataFrame, token: str = "token", random: str = "random", threshold: float = 0.35, shortest: int = 16) -> MarkovModel:
    """Count both models from rows of (token, random boolean); add-one smoothing over the pairs of printable characters.

    Two rows per character pair at most come to the driver.
    """
    own = samples.select(F.col(quoted(token)).alias("t"), F.col(quoted(random)).alias("r")).where(f"r is not null and length(t) > 1 and t rlike '^{TOKEN}+$'")
    counts = own.select("r", F.explode(_pairs(F.col("t"))).alias("at")).groupBy("r", "at").count().collect()
    table = {True: {}, False: {}}
    for r, at, n in counts:
        table[r][at] = n
    if not table[True] or not table[False]:
        return MarkovModel([0.0], float("inf"), shortest)
    import math

    def logs(seen: dict[int, int]) -> list[float]:
        rows = [sum(seen.get(a * ALPHABET + b, 0) for b in range(ALPHABET)) for a in range(ALPHABET)]
        return [math.log((seen.get(a * ALPHABET + b, 0) + 1) / (rows[a] + 64)) for a in range(ALPHABET) for b in range(ALPHABET)]

    signs = [i for i in range(ALPHABET) if not chr(i).isalnum()]
    silent = {a * ALPHABET + b for a in signs for b in signs} - {*table[True], *table[False]}  # rules of hyphens and the like
    ratios = [0.0 if i in silent else round(x - y, 4) for i, (x, y) in enumerate(zip(logs(table[True]), logs(table[False])))]
    return MarkovModel(ratios, threshold, shortest)


def labelled_tokens(docs: DataFrame, text_col: str = "text", rows: int = 4000) -> DataFrame:
    """Labelled sample from about `rows` distinct texts of either kind (by a hash): values of base matches are random strings,
    letter tokens of 6 characters or more elsewhere are ordinary."""
    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    sure = docs.select(text.alias("t")).where(F.col("t").rlike(f"{ASSIGN}|AKIA[A-Z0-9]{{16}}|[0-9a-f]{{24}}"))
    values = F.concat(F.regexp_extract_all("t", F.lit(f"{ASSIGN}([A-Za-z0-9+/_=-]{{12,}})"), F.lit(1)),
                      F.regexp_extract_all("t", F.lit("AKIA[A-Z0-9]{16,}"), F.lit(0)), F.regexp_extract_all("t", F.lit("[0-9a-f]{24,}"), F.lit(0)))
    random = hashed_sample(sure, "t", rows).select(F.explode(values).alias("token")).distinct().select("token", F.lit(True).alias("random"))
    letters = F.regexp_extract_all("t", F.lit(r"(?<![A-Za-z0-9+/_=-])[A-Za-z]+(?:[_-][A-Za-z]+)*(?![A-Za-z0-9+/_=-])"), F.lit(0))
    plain = hashed_sample(docs.select(text.alias("t")), "t", rows).select(F.explode(letters).alias("token")).where("length(token) >= 6").select("token", F.lit(False).alias("random"))
    return random.union(plain)


def markov_spans(text: Column, base: Column, model: MarkovModel) -> Column:
    """Tokens that the models take for random, away from the base spans."""
    none = F.array().cast(f"array<{SPAN}>")
    if model.threshold == float("inf"):
        return none
    table = F.from_json(F.lit(str(model.ratios)), "array<double>")
    long = f"(?<!{TOKEN}){TOKEN}{{{model.shortest},}}"

    def odd(token: Column) -> Column:
        sums = F.aggregate(_pairs(token), F.lit(0.0), lambda s, at: s + F.get(table, at))
        return sums > model.threshold * (F.length(token) - 1)

    spans = _found(text, long, 3, odd)
    apart = F.filter(spans, lambda s: ~F.exists(base, lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"])))
    return F.when(text.rlike(f"{TOKEN}{{{model.shortest}}}"), apart).otherwise(none)


def find_spans(docs: DataFrame, model: MarkovModel, text_col: str = "text", base: str = "base", found: str = "found") -> DataFrame:
    """docs with two more columns: base spans, and all spans in order."""
    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    first = docs.withColumn(base, base_spans(text))
    return first.withColumn(found, F.array_sort(F.concat(F.col(base), markov_spans(text, F.col(base), model))))


def joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))))


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every stretch that spans cover replaced by one mark."""
    state = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(s: Column, x: Column) -> Column:
        gap = F.substring(text, (s["at"] + 1).cast("int"), F.greatest(x["start"] - s["at"], F.lit(0)).cast("int"))
        more = F.when(x["start"] < s["at"], s["out"]).otherwise(F.concat(s["out"], gap, F.lit(mark)))
        return F.struct(F.greatest(s["at"], x["stop"]).alias("at"), more.alias("out"))

    def finish(s: Column) -> Column:
        return F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text)))

    return F.when(F.size(spans) > 0, F.aggregate(spans, state, step, finish)).otherwise(text)
