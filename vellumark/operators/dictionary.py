"""Names of a dictionary found in one pass over each text, by an automaton over tokens.

The names form a trie; a node's failure link leads to the longest proper suffix
of its tokens that also begins a name, so after any token the automaton stands
where the longest open name goes on, and no text is read twice, however many
names there are and however they overlap.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections import Counter, deque
from collections.abc import Iterable
from functools import cache


def _letters(begin: int, end: int) -> str:
    """The letters of a range of code points, as ranges of a class."""
    letters, first = [], None
    for code in range(begin, end + 1):
        is_letter = code < end and unicodedata.category(chr(code)).startswith("L")
        if is_letter and first is None:
            first = code
        elif not is_letter and first is not None:
            letters.append(f"\\U{first:08x}-\\U{code - 1:08x}")
            first = None
    return "".join(letters)


@cache
def token_pattern() -> re.Pattern:
    """A word (letters, digits of ASCII, underscores) or one other sign that is no white space, as in `enrichment.TOKEN_PATTERN`.

    A class of code points below 0x10000 is a table; one with letters beyond is
    a list of ranges, walked for every sign. So those letters are asked for only
    where the next sign is `beyond`.
    """
    word, high = "A-Za-z0-9_" + _letters(128, 0x10000), _letters(0x10000, sys.maxunicode + 1)
    beyond = r"\U00010000-\U0010ffff"
    near, far = f"[{word}]+", f"(?=[{beyond}])[{high}]+"
    return re.compile(
        f"{near}(?:{far}(?:{near})?)*|{far}(?:{near}|{far})*"
        f"|[^{word}{beyond} \\t\\n\\x0b\\f\\r]|(?=[{beyond}])[^{high}]"
    )


class Automaton:
    """Plain lists and dicts, so that it is cheap to send: per node the next nodes by token number, the failure link, the names."""

    def __init__(self, names: Iterable[str]):
        self.names = sorted(set(names))
        self.numbers: dict[str, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.fail = [0]
        self.ends: list[tuple[int, ...]] = [()]
        pattern = token_pattern()
        for i, name in enumerate(self.names):
            tokens = pattern.findall(name)
            if tokens:
                self._add([self.numbers.setdefault(t, len(self.numbers) + 1) for t in tokens], i)
        self._link()
        self.first = {t for t, n in self.numbers.items() if n in self.next[0]}

    def _add(self, tokens: list[int], name: int) -> None:
        node = 0
        for t in tokens:
            if t not in self.next[node]:
                self.next[node][t] = len(self.next)
                self.next.append({})
                self.fail.append(0)
                self.ends.append(())
            node = self.next[node][t]
        self.ends[node] += (name,)  # names of equal tokens but other spacing

    def _link(self) -> None:
        waiting = deque(self.next[0].values())
        while waiting:
            node = waiting.popleft()
            for t, child in self.next[node].items():
                at = self.fail[node]
                while at and t not in self.next[at]:
                    at = self.fail[at]
                self.fail[child] = self.next[at].get(t, 0)
                self.ends[child] += self.ends[self.fail[child]]  # the suffix is a node nearer to the root: done before
                waiting.append(child)

    def count(self, text: str) -> Counter:
        """How often each name, by number, occurs in a text."""
        found: Counter = Counter()
        number, follow, ends = self.numbers.get, self.next, self.ends
        node = 0
        tokens = token_pattern().findall(text)
        if self.first.isdisjoint(tokens):  # no name begins
            return found
        for token in tokens:
            t = number(token)
            if t is None:  # in no name at all
                node = 0
                continue
            while node and t not in follow[node]:
                node = self.fail[node]
            node = follow[node].get(t, 0)
            if ends[node]:
                found.update(ends[node])
        return found
