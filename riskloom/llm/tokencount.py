"""Exact token counts of every prefix, by dynamic programming over merge tokens.

Byte-pair merges have a property that makes counting prefixes cheap: a text's tokens
without the last one are the tokens of what they cover. So the tokens of a prefix are
those of a shorter prefix and one token more, and the right last token is the one that
merging would not have joined with its neighbour, or split differently: `joinable`
undoes merges on both sides of a border to tell. A word's table has, for each prefix, the
last token and the count, for the prefix inside the word and for the prefix as a whole
word (with its end mark). A text's table has the count before each of its stretches
between white space; with both, the count of any prefix and the longest prefix within a
budget are looked up, nothing is encoded again.

Prefixes are those of the normalized text (NFC, blanks instead of white space, lower case).

Defined cases: null and empty texts have no tokens; control strings of the vocabulary
inside a text count as the tokenizer has it, one token each.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from riskloom.llm.batches import Memo, append_columns

_BLANKS = re.compile("[ \t\n\r\x0b\x0c]+")
#: Stretches that go to the library at once.
GROUP = 4000


class PrefixCounts:
    """Prefix tables of the words of a tokenizers file: merges over bytes, with an end-of-word mark."""

    def __init__(self, path: str, remembered: int = 300_000):
        import ahocorasick
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        own = model["model"]
        self.end = own["end_of_word_suffix"] or ""
        self.vocabulary = own["vocab"]
        self.special = [t["content"] for t in model["added_tokens"]]
        self.split = {i: (i, i) for i in self.vocabulary.values()}
        self.merged = {}
        for left, right in own["merges"]:
            joined = self.vocabulary[left + right]
            a, b = self.vocabulary[left], self.vocabulary[right]
            self.merged[a, b] = joined
            self.split[joined] = (a, b)
        self.order = {i: n for n, i in enumerate([*(i for i in self.split if self.split[i] == (i, i)), *(self.merged[k] for k in self.merged)])}
        self.finals = {t.removesuffix(self.end): i for t, i in self.vocabulary.items() if t.endswith(self.end)}
        self.longest = max(len(t.removesuffix(self.end)) for t in self.vocabulary)
        self.endings = ahocorasick.Automaton()
        for text, i in self.vocabulary.items():
            if not self.end or not text.endswith(self.end):
                self.endings.add_word(text, (len(text), i))
        self.endings.make_automaton()
        self.joinable = lru_cache(1 << 18)(self._joinable)
        self.known = Memo(self._counts, remembered)

    def _joinable(self, left: int, right: int) -> bool:
        """Whether merging leaves the border between two tokens alone."""
        limit, order = float("inf"), self.order
        while True:
            joined = self.merged.get((left, right))
            if joined is not None and order[joined] < limit:
                return False
            if order[left] > order[right]:
                limit, left = order[left], self.split[left][1]
                if order[left] == limit:
                    limit, right = order[right] + 1, self.split[right][0]
                    if order[right] + 1 == limit:
                        return True
            else:
                limit, right = order[right] + 1, self.split[right][0]
                if order[right] + 1 == limit:
                    limit, left = order[left], self.split[left][1]
                    if order[left] == limit:
                        return True

    def _extend(self, word: str, upto: int, tokens: list[int], counts: list[int]) -> None:
        """Add last token and count of the prefixes inside a word, up to a length; shorter ones are there.

        The automaton gives the tokens that end at each place, the longest first.
        """
        have, joinable = len(counts) - 1, self.joinable
        if have >= upto:
            return
        for at, (size, token) in self.endings.iter(word, max(0, have + 1 - self.longest), upto):
            begin = at + 1 - size
            if at == have and (not begin or joinable(tokens[begin], token)):
                tokens.append(token)
                counts.append(counts[begin] + 1)
                have += 1
        if have < upto:
            raise ValueError(f"no tokens for {word[: have + 1]!r}")

    def _whole(self, word: str, end: int, tokens: list[int], counts: list[int]) -> int:
        """Tokens of a prefix as a word of its own, from the prefixes inside it."""
        for begin in range(max(0, end - self.longest), end):
            token = self.finals.get(word[begin:end])
            if token is not None and (not begin or self.joinable(tokens[begin], token)):
                return counts[begin] + 1
        raise ValueError(f"no tokens for {word[:end]!r}")

    def _counts(self, words: list[str]) -> list[int]:
        """Tokens of each word. In alphabetical order a word goes on from the prefixes it shares with the one before."""
        found, tokens, counts, before = {}, [-1], [0], ""
        for word in sorted(words):
            same, most = 0, min(len(word), len(before)) - 1
            while same < most and word[same] == before[same]:
                same += 1
            del tokens[same + 1 :], counts[same + 1 :]
            self._extend(word, len(word) - 1, tokens, counts)
            found[word] = self._whole(word, len(word), tokens, counts)
            before = word
        return [found[w] for w in words]

    def words(self, stretch: str) -> list[str]:
        """The words of a stretch as the library splits it, in the vocabulary's byte characters."""
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(stretch))]

    def _split(self, group: list[str]) -> list[list[str]]:
        """The words of each of many stretches without white space, by one call of the library.

        Neither its normalizer nor its splitting reaches over the blanks put between them.
        """
        text = self.library.normalizer.normalize_str(" ".join(group))
        ends = np.cumsum([len(s) + 1 for s in text.split(" ")])
        pairs = self.library.pre_tokenizer.pre_tokenize_str(text)
        if len(ends) != len(group):
            return [self.words(s) for s in group]
        out = [[] for _ in group]
        for (word, _), at in zip(pairs, np.searchsorted(ends, [begin for _, (begin, _) in pairs], side="right")):
            out[at].append(word)
        return out

    def count(self, word: str) -> int:
        """Tokens of a word."""
        return self.known.of({word})[word]

    def of_prefixes(self, word: str) -> list[int]:
        """Tokens of each prefix of a word as a word of its own, by length in byte characters."""
        tokens, counts = [-1], [0]
        self._extend(word, len(word) - 1, tokens, counts)
        return [self._whole(word, end, tokens, counts) for end in range(1, len(word) + 1)]

    def of_stretch(self, stretch: str) -> int:
        if any(s in stretch for s in self.special):
            cut = re.split("|".join(map(re.escape, self.special)), stretch)
            return len(cut) - 1 + sum(self.of_stretch(x) for x in cut if x)
        return sum(map(self.count, self.words(stretch)))

    def stretches(self, stretches: list[str]) -> list[int]:
        """Tokens of each stretch; those with control strings or odd white space are taken one by one."""
        plain = {s: [s.lower()] for s in stretches if s.isascii() and s.isalpha()}
        other = [s for s in stretches if s not in plain and len(s.split()) == 1 and not any(x in s for x in self.special)]
        for start in range(0, len(other), GROUP):
            group = other[start : start + GROUP]
            plain.update(zip(group, self._split(group)))
        table = self.known.of(set().union(*plain.values()))
        return [sum(map(table.__getitem__, plain[s])) if s in plain else self.of_stretch(s) for s in stretches]


@lru_cache(1)
def _remembered(path: str) -> Memo:
    """Counts of stretches by the vocabulary of a path, kept by a Python worker from task to task."""
    return Memo(PrefixCounts(path).stretches, limit=400_000)


def prefix_table(stretches: list[str], counts: dict[str, int]) -> np.ndarray:
    """Tokens before each stretch of a text, and in all of it at the end."""
    return np.r_[0, np.cumsum(np.fromiter(map(counts.__getitem__, stretches), np.int64, len(stretches)))]


def fitting(stretches: list[str], table: np.ndarray, budget: int, counts: PrefixCounts) -> str:
    """The longest prefix of the text, normalized, that has at most `budget` tokens.

    Only the stretch where the budget ends is looked into, at its words' prefix tables.
    """
    whole = int(np.searchsorted(table, budget, side="right")) - 1
    text = " ".join(stretches[:whole])
    if whole == len(stretches) or any(s in stretches[whole] for s in counts.special):
        return counts.library.normalizer.normalize_str(text)
    left, best = budget - int(table[whole]), ""
    stretch = counts.library.normalizer.normalize_str(stretches[whole])
    for end in range(1, len(stretch) + 1):
        if sum(counts.of_prefixes(w)[-1] for w in counts.words(stretch[:end])) <= left:
            best = stretch[:end]
    return " ".join(filter(None, [counts.library.normalizer.normalize_str(text), best]))


def count_texts(df: DataFrame, text: str, path: str, keep: list[str], limit: int = 2048) -> DataFrame:
    """The kept columns, `n_bytes`, `n_tokens`, `over_limit` and `whole_words`: the stretches that fit the limit whole."""
    def make():
        memo = _remembered(path)

        def function(texts: list[str | None]) -> list:
            own = [[s for s in _BLANKS.split(t) if s] if t else [] for t in texts]
            table = memo.of(set().union(*own))
            tables = [prefix_table(s, table) for s in own]
            total = [int(t[-1]) for t in tables]
            return [[len(t.encode("utf-8", "surrogatepass")) if t else 0 for t in texts], total, [n > limit for n in total],
                    [int(np.searchsorted(t, limit, side="right")) - 1 for t in tables]]

        return function

    return append_columns(df, text, make, "n_bytes long, n_tokens long, over_limit boolean, whole_words long", keep)
