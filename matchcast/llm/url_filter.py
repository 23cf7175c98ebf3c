"""URL rules as a bit-parallel wildcard automaton.

Glob rules are packed into the bits of 64-bit words, each rule a start bit and a bit per literal or ``?``; one step of extended
Shift-And per byte moves all rules of all URLs of a batch at once. Globs: ``*`` any run without ``/``, ``**`` any run, ``?`` one
character. A rule matches a whole canonical URL: the host in lower case and the path.

Of the matching rules the first in priority wins; without one the verdict is ``allow``.

Defined cases: a null url, or one without ``://``, has empty host and path; an empty host matches no rule that needs one; repeated
rows give repeated results; of rules of equal length the first listed wins; URLs of any length are matched whole, in a step per byte of the
longest URL of a portion, over the rows that still go on; other columns are ignored; an empty table gives an empty table of the same
schema.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from matchcast.shared import bounded
from matchcast.llm.vec import chunks, utf8


@dataclass(frozen=True)
class Rule:
    """``name`` is reported where the rule is one of a list by host and path; ``globs``: any of them matches."""

    globs: tuple[str, ...]
    verdict: str
    name: str | None = None


def host_rule(host: str, path: str, verdict: str) -> Rule:
    """Fits the host and all its subdomains, where the URL's path starts with ``path``."""
    return Rule((f"{host}{path}**", f"*.{host}{path}**"), verdict, host + path)


#: Rules by host and path. The longest that fits wins.
HOST_RULES = (
    host_rule("com", "/en/", "block"),
    host_rule("example.com", "/en/7", "allow"),
    host_rule("net", "/de/", "allow"),
    host_rule("example.net", "/de/8", "block"),
    host_rule("org", "/es/", "block"),
)
#: Rules for all other URLs: downloads, advertising and search or login pages.
GLOB_RULES = (
    Rule(("**.exe", "**.zip", "**.apk", "**.iso"), "block"),
    Rule(("ads.*/**", "ad.*/**", "*.ads.*/**", "**/ads/**", "**/banner?/**"), "block"),
    Rule(("**/login", "**/login/**", "**/search/**", "**/cart/**"), "block"),
)


class Automaton:
    """Masks over all rules' globs: bit 0 of a glob is its start, the others its literals."""

    def __init__(self, rules: list[Rule]):
        moves, loops, starts, ends, owner = [], [], [], [], []
        any_byte, tail = np.ones(256, bool), np.zeros(256, bool)
        tail[0x80:0xC0] = True
        inner = any_byte.copy()
        inner[ord("/")] = False
        for r, rule in enumerate(rules):
            for glob in rule.globs:
                starts.append(len(moves))
                moves.append(np.zeros(256, bool))
                loops.append(np.zeros(256, bool))
                i = 0
                while i < len(glob):
                    if glob.startswith("**", i):
                        loops[-1] = loops[-1] | any_byte
                        i += 2
                        continue
                    if glob[i] == "*":
                        loops[-1] = loops[-1] | inner
                    elif glob[i] == "?":  # the first byte of a character; its others stay
                        moves.append(~tail)
                        loops.append(tail.copy())
                    else:
                        for b in glob[i].encode():
                            own = np.zeros(256, bool)
                            own[b] = True
                            moves.append(own)
                            loops.append(np.zeros(256, bool))
                    i += 1
                ends.append(len(moves) - 1)
                owner.append(r)
        self.words = -(-len(moves) // 64)
        self.move, self.loop = self.masks(moves), self.masks(loops)
        self.first = self.bits(starts)
        self.ends, self.owner, self.rules = np.array(ends), np.array(owner), len(rules)

    def bits(self, at: list[int]) -> np.ndarray:
        out = np.zeros(self.words, np.uint64)
        for i in at:
            out[i // 64] |= np.uint64(1) << np.uint64(i % 64)
        return out

    def masks(self, table: list[np.ndarray]) -> np.ndarray:
        flat = np.zeros((256, self.words * 64), np.uint8)
        flat[:, : len(table)] = np.array(table, np.uint8).T
        return np.packbits(flat, axis=1, bitorder="little").view(np.uint64)

    def match(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """For each row of bytes, whether each rule matches it whole."""
        n = len(offsets) - 1
        sizes = np.diff(offsets)
        by = np.argsort(-sizes, kind="stable")  # at each step, the rows that go on stand in front
        at, left = offsets[:-1][by], sizes[by]
        state = np.tile(self.first, (n, 1))
        live = n
        for step in range(int(left[0]) if n else 0):
            live = int(np.searchsorted(-left[:live], -step, "left"))
            own = state[:live]
            c = data[at[:live] + step]
            carried = own << np.uint64(1)
            carried[:, 1:] |= own[:, :-1] >> np.uint64(63)
            state[:live] = carried & self.move[c] | own & self.loop[c]
        done = state[:, self.ends // 64] >> (self.ends % 64).astype(np.uint64) & np.uint64(1) != 0
        out = np.zeros((n, self.rules), bool)
        for g, r in enumerate(self.owner):
            out[by, r] |= done[:, g]
        return out


def canonical(url: F.Column) -> tuple[F.Column, F.Column]:
    """Host with A-Z in lower case, and path, as column expressions."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def judge(pages: DataFrame, url: str = "url", key: str = "page_id", host_rules: tuple[Rule, ...] = HOST_RULES, glob_rules: tuple[Rule, ...] = GLOB_RULES) -> DataFrame:
    """host, path, rule (null where none by host and path fits) and verdict of every URL."""
    named = sorted(host_rules, key=lambda r: -len(r.name or ""))
    rules = [*named, *glob_rules, Rule(("**",), "allow")]
    names = pa.array([r.name for r in rules], pa.string())
    verdicts = pa.array([r.verdict for r in rules], pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(rules)
        for batch in batches:
            data, offsets = utf8(batch.column(3))
            for a, b in chunks(offsets, 1 << 19):
                own = automaton.match(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                best = pa.array(own.argmax(1))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns[:3], names.take(best), verdicts.take(best)], ["page_id", "host", "path", "rule", "verdict"])

    host, path = canonical(F.col(url).cast("string"))
    parts = bounded(pages).select(F.col(key).cast("bigint").alias("page_id"), host.alias("host"), path.alias("path"))
    return parts.select("*", F.concat("host", "path").alias("whole")).mapInArrow(run, "page_id bigint, host string, path string, rule string, verdict string")


#: The same verdicts by regular expressions.
SQL = r"""
WITH p AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), q AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p
), r AS (
  SELECT page_id, host, path,
    CASE WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/7') THEN 'example.com/en/7'
         WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/de/8') THEN 'example.net/de/8'
         WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/en/') THEN 'com/en/'
         WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/de/') THEN 'net/de/'
         WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/es/') THEN 'org/es/' END AS rule
  FROM q
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('com/en/', 'example.net/de/8', 'org/es/') THEN 'block'
       WHEN rule IS NOT NULL THEN 'allow'
       WHEN regexp_matches(host || path, '\.(exe|zip|apk|iso)$') THEN 'block'
       WHEN regexp_matches(host || path, '^([^/]*\.)?ads\.[^/]*/') OR regexp_matches(host || path, '^ad\.[^/]*/')
         OR regexp_matches(host || path, '/ads/') OR regexp_matches(host || path, '/banner./') THEN 'block'
       WHEN regexp_matches(host || path, '/login$') OR regexp_matches(host || path, '/(login|search|cart)/') THEN 'block'
       ELSE 'allow' END AS verdict
FROM r
"""
