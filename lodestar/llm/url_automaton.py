"""URL rules as globs, all matched at once by one bit-parallel automaton.

Every glob is a run of states in a row of 64-bit words: bit k is set after a prefix of the URL has
matched the glob's first k elements. A character moves all states of all globs with one shift, one
mask and, for wildcards, one mask that keeps states where they are (Shift-And). The batch is
processed column by column: one step takes the next byte of every URL.

``*`` stands for any run without a slash, ``**`` for any run, ``?`` for one byte but a slash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER

URLS_AT_ONCE = 4096
SLASH = ord("/")


@dataclass(frozen=True)
class Rule:
    """Blocks or allows URLs. ``glob`` is matched against "." + host + path as a whole."""

    glob: str
    block: bool
    name: str | None = None  # a host-and-path rule's text


def host_rule(host: str, path: str, block: bool) -> Rule:
    """A rule for ``host`` and its subdomains and all paths that start with ``path``."""
    return Rule(f"*.{host}{path}**", block, f"{host}{path}")


class Automaton:
    """Masks of all globs. A glob of n elements takes n + 1 bits; bits may straddle words."""

    def __init__(self, globs: list[str]):
        elements = [list(_elements(glob)) for glob in globs]
        bits = sum(len(e) + 1 for e in elements)
        self.words = -(-bits // 64) or 1
        take = np.zeros((256, self.words), np.uint64)   # states that a byte may enter
        stay = np.zeros((256, self.words), np.uint64)   # states in which a byte may stay
        self.start = np.zeros(self.words, np.uint64)
        self.ends: list[tuple[int, np.uint64]] = []
        at = 0
        for glob in elements:
            self._set(self.start, at)
            for kind in glob:
                if kind in ("*", "**"):
                    for byte in range(256):
                        if kind == "**" or byte != SLASH:
                            self._set(stay[byte], at)
                    continue
                at += 1
                for byte in ([b for b in range(256) if b != SLASH] if kind == "?" else [kind]):
                    self._set(take[byte], at)
            self.ends.append((at // 64, np.uint64(1 << at % 64)))
            at += 1
        self.take, self.stay = take, stay

    @staticmethod
    def _set(row: np.ndarray, bit: int) -> None:
        row[bit // 64] |= np.uint64(1 << bit % 64)

    def matches(self, texts: list[bytes]) -> np.ndarray:
        """(texts, globs) booleans: which glob matches which whole text."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        order = np.argsort(-sizes, kind="stable")
        joined = np.frombuffer(b"".join(texts), np.uint8)
        begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])[order]
        down = sizes[order]
        state = np.repeat(self.start[None, :], len(texts), axis=0)
        live = len(texts)
        for step in range(int(sizes.max(initial=0))):
            while live and down[live - 1] <= step:
                live -= 1
            byte = joined[begin[:live] + step]
            now = state[:live]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:live] = (moved & self.take[byte]) | (now & self.stay[byte])
        found = np.empty((len(texts), len(self.ends)), bool)
        for k, (word, bit) in enumerate(self.ends):
            found[order, k] = (state[:, word] & bit) != 0
        return found


def _elements(glob: str):
    data, at = glob.encode(), 0
    while at < len(data):
        if data[at:at + 2] == b"**":
            yield "**"
            at += 2
        else:
            yield {ord("*"): "*", ord("?"): "?"}.get(data[at], data[at])
            at += 1


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host (A-Z in lower case) and path of a URL; both empty for null or without "://"."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def judge(pages: DataFrame, rules: list[Rule], id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict) for each row of ``pages``.

    Of the named rules that match, that with the longest name decides (of equal ones the first); if none
    does, a URL is blocked if an unnamed blocking glob matches it and no unnamed allowing one does. Null
    urls and urls without a host match nothing and are allowed. Repeated rows are judged alike.
    """
    order = sorted(range(len(rules)), key=lambda k: -len(rules[k].name or ""))
    named = [k for k in order if rules[k].name is not None]
    other = [k for k in order if rules[k].name is None]

    def run(batches):
        automaton = Automaton([rule.glob for rule in rules])
        for batch in batches:
            for at in range(0, batch.num_rows, URLS_AT_ONCE):
                part = batch.slice(at, URLS_AT_ONCE)
                hosts, paths = part.column(1).to_pylist(), part.column(2).to_pylist()
                found = automaton.matches([f".{h}{p}".encode() for h, p in zip(hosts, paths)])
                picked, verdicts = [], []
                some = found[:, named].any(axis=1) if named else np.zeros(len(found), bool)
                blocked = _any(found, [k for k in other if rules[k].block]) \
                    & ~_any(found, [k for k in other if not rules[k].block])
                for row in range(len(found)):
                    rule = next(rules[k] for k in named if found[row, k]) if some[row] else None
                    picked.append(rule.name if rule else None)
                    block = rule.block if rule else blocked[row]
                    verdicts.append("block" if block else "allow")
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(picked, pa.string()), pa.array(verdicts)],
                    names=["id", "host", "path", "rule", "verdict"])

    host, path = host_and_path(F.col(url_col))
    slim = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    return slim.mapInArrow(run, f"id {slim.schema['id'].dataType.simpleString()}, host string, "
                                "path string, rule string, verdict string")


def _any(found: np.ndarray, columns: list[int]) -> np.ndarray:
    return found[:, columns].any(axis=1)
