"""Secret scan: a trigram index of the texts proposes candidates to each rule's regular expression."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import product
from re import _constants as codes
from re import _parser as parser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ravelin.llm.common import slices, table, texts_of

#: A part of a pattern is spelled out as a set of strings up to this size.
SPELLED = 64

#: None: every text qualifies. Else alternatives, each the trigrams that must all occur.
Query = frozenset[frozenset[str]] | None


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, and the least length of a group; shorter matches are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    any_case: bool = False

    def compiled(self) -> re.Pattern[str]:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32),
)
MORE_RULES = (
    Rule("repository_token", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("payment_key", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("web_token", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
)
RULES = BASE_RULES + MORE_RULES


def _either(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return None
    every = a | b
    return frozenset(x for x in every if not any(y < x for y in every))


def _both(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return b if a is None else a
    every = frozenset(x | y for x, y in product(a, b))
    return frozenset(x for x in every if not any(y < x for y in every))


def _needs(strings: set[str]) -> Query:
    """Trigrams of texts that hold one of the strings."""
    if any(len(s) < 3 for s in strings):
        return None
    needed: Query = frozenset()
    for s in strings:
        needed = _either(needed, frozenset([frozenset(s[i : i + 3] for i in range(len(s) - 2))]))
    return needed


def _letters(items: list) -> set[str] | None:
    found: set[str] = set()
    for op, value in items:
        if op is codes.LITERAL:
            found.add(chr(value).lower())
        elif op is codes.RANGE and value[1] - value[0] < 8:
            found.update(chr(c).lower() for c in range(value[0], value[1] + 1))
        else:
            return None
    return found


def _walk(nodes: Sequence) -> tuple[set[str] | None, Query]:
    """The strings that `nodes` match if they can be spelled out (else None), and what any match needs."""
    spelled, query, run, whole = {""}, None, {""}, True
    for op, value in nodes:
        strings, needs = _node(op, value)
        if strings is not None and len(run) * len(strings) <= SPELLED:
            run = {a + b for a, b in product(run, strings)}
            continue
        whole, query = False, _both(_both(query, _needs(run)), needs if strings is None else _needs(strings))
        run = {""}
    spelled = run if whole else None
    return spelled, _both(query, _needs(run))


def _node(op, value) -> tuple[set[str] | None, Query]:
    if op is codes.LITERAL:
        return {chr(value).lower()}, None
    if op is codes.IN:
        return _letters(value), None
    if op is codes.SUBPATTERN:
        return _walk(value[3])
    if op is codes.BRANCH:
        branches = [_walk(b) for b in value[1]]
        strings = None if any(s is None for s, _ in branches) else set().union(*(s for s, _ in branches))
        query = branches[0][1]
        for _, q in branches[1:]:
            query = _either(query, q)
        return strings, query
    if op in (codes.MAX_REPEAT, codes.MIN_REPEAT):
        least, most, inner = value
        strings, query = _walk(inner)
        if strings is not None and (least, most) == (0, 1):
            return strings | {""}, None
        if strings is not None and least == most and len(strings) ** least <= SPELLED:
            return {"".join(x) for x in product(strings, repeat=least)}, None
        return None, query if least else None
    if op is codes.AT:
        return {""}, None
    return None, None


def trigram_query(rule: Rule) -> Query:
    """The Boolean trigram query that every text with a match of `rule` satisfies, over lower-cased trigrams."""
    return _walk(parser.parse(rule.pattern))[1]


class TrigramIndex:
    """Postings of the asked trigrams over some texts: the shard of the inverted index that these texts make up."""

    def __init__(self, texts: pa.Array, trigrams: set[str]) -> None:
        lower = pc.ascii_lower(texts)
        self.rows = len(texts)
        self.postings = {t: np.flatnonzero(np.asarray(pc.match_substring(lower, t))) for t in trigrams}

    def candidates(self, query: Query) -> np.ndarray:
        if query is None:
            return np.arange(self.rows)
        found = np.empty(0, dtype=np.int64)
        for needed in query:
            rows: np.ndarray | None = None
            for posting in sorted((self.postings[t] for t in needed), key=len):
                rows = posting if rows is None else np.intersect1d(rows, posting, assume_unique=True)
            found = np.union1d(found, rows)
        return found.astype(np.int64)


def scanner(rules: Sequence[Rule]) -> Callable[[pa.Array], list[list[tuple[str, int, int]]]]:
    """Spans (kind, start, end) of every text, by start and then by the rules' order."""
    plans = [(rule, rule.compiled(), trigram_query(rule)) for rule in rules]
    trigrams = {t for _, _, query in plans for some in query or () for t in some}

    def scan(texts: pa.Array) -> list[list[tuple[str, int, int]]]:
        index, values = TrigramIndex(texts, trigrams), texts.to_pylist()
        found: list[list[tuple[int, int, str, int]]] = [[] for _ in values]
        for place, (rule, pattern, query) in enumerate(plans):
            for row in index.candidates(query).tolist():
                for match in pattern.finditer(values[row]):
                    if match.end(rule.group) - match.start(rule.group) >= rule.least:
                        found[row].append((match.start(), place, rule.kind, match.end()))
        return [[(kind, start, end) for start, _, kind, end in sorted(spans)] for spans in found]

    return scan


def find_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """`docs` with `secrets`: the kind, start and end (code points, end exclusive) of every match, by start.

    Each rule's pattern is turned into a Boolean query over lower-cased trigrams: a match must hold them. The texts of a
    slice are indexed under the trigrams that some rule asks for; a rule's postings are intersected and joined, and its
    pattern runs over the remaining texts alone. A rule without mandatory trigrams scans every text. The index is dealt
    out by document, so nothing is shuffled, and each span list depends on its own text only.

    Matches are leftmost and do not overlap within a rule; those whose group is shorter than the rule's least length are
    dropped. Null and empty texts have an empty list, repeated rows stay, an empty table gives an empty one, and a
    column called secrets is replaced.
    """
    docs = docs.drop("secrets")
    kept = docs.columns
    scan = scanner(tuple(rules))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for part in slices(batches):
            spans = scan(pa.array(texts_of(part, text), pa.string()))
            rows = [[{"kind": k, "start": s, "end": e} for k, s, e in row] for row in spans]
            yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + [pa.array(rows, kind)], names=[*kept, "secrets"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{schema}, secrets array<struct<kind string, start long, end long>>")


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and digests of the secrets of every document."""
    scanned = find_secrets(table(spark, folder, "documents").select("doc_id", "text"))
    base = [r.kind for r in BASE_RULES]
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    return scanned.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in base),
        F.sha2(joined(F.filter("secrets", lambda s: s["kind"].isin(base))).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
    )
