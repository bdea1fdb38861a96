"""URL filter rules as one bit-parallel automaton.

All glob rules lie side by side in the bits of one state of several 64-bit words; bit i of a
rule is set when its first i literals have been read. A byte moves every rule at once:
``state = (state << 1) & follows[byte] | state & stays[byte]``. Whole batches of URLs advance
together, one byte position at a time, so the work per byte does not depend on the number
of rules up to 64 bits and grows by a word for each further 64.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

U = np.uint64
STEP_ROWS = 4096


@dataclass(frozen=True)
class Rule:
    """``glob`` is matched against the whole canonical URL (host + path): ``*`` is any run of
    bytes without a slash, ``**`` any run at all. The longest ``name`` of all hits decides."""

    name: str
    verdict: str
    glob: str


def host_rules(entries: Sequence[tuple[str, str]]) -> list[Rule]:
    """(verdict, ``host/path``) as globs for the host itself and its subdomains."""
    return [Rule(name, verdict, lead + name + "**") for verdict, name in entries for lead in ("", "*.")]


def _parse(glob: str) -> tuple[bytes, dict[int, bool]]:
    """Literals of a glob, and the number of literals before each wildcard: True if it may cross slashes."""
    literals, loops = b"", {}
    i, raw = 0, glob.encode()
    while i < len(raw):
        if raw[i : i + 1] == b"*":
            wide = raw[i : i + 2] == b"**"
            loops[len(literals)] = loops.get(len(literals), False) or wide
            i += 2 if wide else 1
        else:
            literals += raw[i : i + 1]
            i += 1
    return literals, loops


class Automaton:
    def __init__(self, globs: Sequence[str]):
        parsed = [_parse(g) for g in globs]
        bits = sum(len(literals) + 1 for literals, _ in parsed)
        self.words = max(1, -(-bits // 64))
        self.start = np.zeros(self.words, U)
        self.follows, self.stays = np.zeros((256, self.words), U), np.zeros((256, self.words), U)
        self.finals: list[tuple[int, np.uint64]] = []
        at = 0
        for literals, loops in parsed:
            self._set(self.start, at)
            for i, byte in enumerate(literals):
                self._set(self.follows[byte], at + i + 1)
            for i, wide in loops.items():
                for byte in range(256):
                    if wide or byte != ord("/"):
                        self._set(self.stays[byte], at + i)
            at += len(literals)
            self.finals.append((at // 64, U(1) << U(at % 64)))
            at += 1

    @staticmethod
    def _set(mask: np.ndarray, bit: int) -> None:
        mask[bit // 64] |= U(1) << U(bit % 64)

    def hits(self, texts: Sequence[bytes]) -> np.ndarray:
        """A row per text and a column per rule: does the rule match the whole text."""
        lengths = np.array([len(x) for x in texts], np.int64)
        order = np.argsort(-lengths, kind="stable")
        starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        data = np.frombuffer(b"".join(texts), np.uint8)
        state = np.tile(self.start, (len(texts), 1))
        going = len(order)
        for step in range(int(lengths.max(initial=0))):
            while going and lengths[order[going - 1]] <= step:
                going -= 1
            rows = order[:going]
            byte = data[starts[rows] + step]
            now = state[rows]
            moved = now << U(1)
            moved[:, 1:] |= now[:, :-1] >> U(63)
            state[rows] = (moved & self.follows[byte]) | (now & self.stays[byte])
        return np.stack([(state[:, w] & bit) != 0 for w, bit in self.finals], axis=1) if self.finals else np.zeros((len(texts), 0), bool)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://`` or URL."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def judge_urls(pages: DataFrame, rules: Sequence[Rule], extra: Sequence[Rule], default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict, matched): the verdict of every row of ``pages(page_id, url)``.

    The longest matching rule of ``rules`` decides and is named; without one, the longest of
    ``extra`` decides (``rule`` stays null), then ``default``. Ties of length go to the
    smaller name. ``matched`` counts the globs that hit. Null and malformed URLs have empty host
    and path; repeated rows are judged each; other columns are ignored; no shuffle.
    """
    host, path = host_and_path(F.col("url"))
    frame = pages.select("page_id", F.col("url")).select("page_id", host.alias("host"), path.alias("path"))
    ranked = sorted(rules, key=lambda r: (-len(r.name), r.name)) + sorted(extra, key=lambda r: (-len(r.name), r.name))
    named = len(rules)
    schema = T.StructType([frame.schema["page_id"]]).add("host", "string").add("path", "string").add("rule", "string").add("verdict", "string").add("matched", "long")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton([r.glob for r in ranked])
        for whole in batches:
            for at in range(0, len(whole), STEP_ROWS):
                batch = whole.slice(at, STEP_ROWS)
                keys = [(h + p).encode() for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist())]
                hits = automaton.hits(keys)
                best = np.where(hits.any(axis=1), hits.argmax(axis=1), len(ranked)) if ranked else np.full(len(keys), len(ranked))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("page_id"), batch.column("host"), batch.column("path"),
                     pa.array([ranked[b].name if b < named else None for b in best], pa.string()),
                     pa.array([ranked[b].verdict if b < len(ranked) else default for b in best], pa.string()),
                     pa.array(hits.sum(axis=1), pa.int64())],
                    names=["page_id", "host", "path", "rule", "verdict", "matched"])

    return frame.mapInArrow(judge, schema)
