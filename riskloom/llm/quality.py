"""Quality rules as a short-circuit cascade.

Each rule looks at one measure of a text. On a sample, every rule's cost (seconds a text)
and selectivity (share of texts it rejects) are estimated; rules then run in the order of
rejections per second, and a text leaves at the first rule that rejects it. The verdict
doesn't depend on the order, only the time and the reported reason do. Measures that
several rules share are taken once a text.

Words are runs of bytes other than blank and \\x09 to \\x0D. The sample is about
`sample_rows` distinct texts, chosen by a hash.

Defined cases: a null text has no words, lines or symbols; so has an empty one, and both
fail the rule on too few words. A rule sees whole texts.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from riskloom.llm.batches import append_columns, hashed_sample, quoted

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\r\x0b\x0c"
WINDOW = 5


class View:
    """Measures of one text (UTF-8 bytes), each taken when first asked for."""

    def __init__(self, text: bytes | None):
        self.text = text or b""

    def __getattr__(self, name: str):
        value = MEASURES[name](self)
        setattr(self, name, value)
        return value


def _dup_lines(view: View) -> int:
    lines = [x for x in view.text.split(b"\n") if x.strip(BLANKS)]
    return len(lines) - len(set(lines))


def _repeat_words(view: View) -> int:
    """Words inside windows of five words that occur twice or more; windows are compared by 64-bit hashes."""
    n = len(view.words)
    if n <= WINDOW:
        return 0
    codes = np.fromiter(map(hash, view.words), np.int64, n).view(np.uint64)
    codes = (codes ^ (codes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    windows = codes[: n - WINDOW + 1].copy()
    for i in range(1, WINDOW):
        windows = (windows ^ (windows >> np.uint64(31))) * np.uint64(0x94D049BB133111EB) + codes[i : n - WINDOW + 1 + i]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    twice = np.zeros(len(windows), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    starts = np.flatnonzero(twice)
    if not len(starts):
        return 0
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + WINDOW, -1)
    return int((np.cumsum(change) > 0).sum())


MEASURES: dict[str, Callable] = {
    "words": lambda v: v.text.split(),
    "n_words": lambda v: len(v.words),
    "word_chars": lambda v: len((t := v.text.translate(None, BLANKS)).decode("utf-8", "replace")) if not v.text.isascii() else len(v.text.translate(None, BLANKS)),
    "n_symbols": lambda v: len(v.text) - len(v.text.translate(None, SYMBOLS)),
    "n_dup_lines": _dup_lines,
    "n_lines": lambda v: sum(1 for x in v.text.split(b"\n") if x.strip(BLANKS)),
    "n_repeat_words": _repeat_words,
    "n_distinct": lambda v: len(set(v.words)),
    "n_loud": lambda v: v.text.count(b"!!"),
    "n_same_next": lambda v: sum(map(bytes.__eq__, v.words[1:], v.words)),
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[View], bool]


#: The two rules that the task fixes, and seven of the method's own.
BASE_RULES = (
    Rule("too few words", lambda v: v.n_words < 10),
    Rule("repeated windows", lambda v: 100 * v.n_repeat_words > 20 * v.n_words),
)
METHOD_RULES = (
    Rule("symbols", lambda v: v.n_symbols > 0.5 * v.n_words),
    Rule("shouting", lambda v: v.n_loud > 0.3 * v.n_words),
    Rule("repeated lines", lambda v: v.n_lines >= 4 and v.n_dup_lines > 0.5 * v.n_lines),
    Rule("word length", lambda v: not 1.5 * v.n_words <= v.word_chars <= 25 * v.n_words),
    Rule("same word again", lambda v: v.n_same_next > 0.3 * v.n_words),
)
RULES = BASE_RULES + METHOD_RULES


@dataclass(frozen=True)
class Estimate:
    rule: str
    seconds: float
    rejected: float


def estimate(df: DataFrame, text: str, rules: tuple[Rule, ...] = RULES, sample_rows: int = 500) -> list[Estimate]:
    """Cost and selectivity of each rule on a bounded sample, best rejections per second first."""
    rows = hashed_sample(df, text, sample_rows).collect()
    texts = [r[0].encode("utf-8", "surrogatepass") for r in rows]
    out = []
    for rule in rules:
        began = time.perf_counter()
        rejected = sum(bool(rule.rejects(View(t))) for t in texts)
        out.append(Estimate(rule.name, (time.perf_counter() - began) / max(len(texts), 1), rejected / max(len(texts), 1)))
    return sorted(out, key=lambda e: (-e.rejected / max(e.seconds, 1e-9), e.seconds))


def ordered(rules: tuple[Rule, ...], estimates: list[Estimate]) -> tuple[Rule, ...]:
    place = {e.rule: i for i, e in enumerate(estimates)}
    return tuple(sorted(rules, key=lambda r: place.get(r.name, len(place))))


def _cascade(rules: tuple[Rule, ...]) -> Callable[[View], str | None]:
    return lambda view: next((r.name for r in rules if r.rejects(view)), None)


def first_rejection(df: DataFrame, text: str, rules: tuple[Rule, ...], keep: list[str], name: str) -> DataFrame:
    """The kept columns and the first rule that rejects the text, null for texts to keep. Rules run in the order given."""
    def make():
        verdict = _cascade(rules)
        return lambda texts: [[verdict(View(t)) for t in texts]]

    return append_columns(df, text, make, f"{quoted(name)} string", keep, as_bytes=True)


def measured(df: DataFrame, text: str, rules: tuple[Rule, ...], keep: list[str]) -> DataFrame:
    """The kept columns, the five counts, `base_failed`, `kept` and `rejected_by`.

    The counts are wanted of every text, so the two base rules cost nothing more; the
    method's rules, in the order given, run on what those keep.
    """
    own = tuple(r for r in rules if r not in BASE_RULES)

    def make():
        verdict = _cascade(own)

        def function(texts: list[bytes | None]) -> list:
            rows = []
            for text in texts:
                view = View(text)
                counts = [getattr(view, c) for c in COUNTS]
                base = next((r.name for r in BASE_RULES if r.rejects(view)), None)
                why = base or verdict(view)
                rows.append((*counts, base is not None, why is None, why))
            return list(zip(*rows)) if rows else [[] for _ in range(8)]

        return function

    fields = ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean, rejected_by string"
    return append_columns(df, text, make, fields, keep, as_bytes=True)
