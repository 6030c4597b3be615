"""Secret scan: all rules in one pass over the bytes, by one combined deterministic automaton.

The rules' expressions are mirrored and compiled together (``automata``: subset construction, minimised,
transition arrays). One pass over each text's bytes, from its end to its start, then tells at
every byte which rules have a match that begins there. A text is cut into lanes behind byte pairs after
which the state no longer depends on what came before, and all lanes of a batch take their
steps together as numpy vectors; a text without such a place is one long lane, so texts of any length
are scanned whole. From a marked byte the rule's forward automaton finds the longest end. Going left to
right and jumping past each match gives a rule's leftmost non-overlapping matches; ``Rule.least`` then drops matches whose last part is too short.

Defined cases: a null or empty text has no spans. Matches of different rules may overlap. Spans are in
code points, ends exclusive, ordered by start, then by the order of the rules. Repeated rows and null
ids give one row each. All columns of the input come back in ``row``, so names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import automata, common

#: Bytes of a lane, about; and steps whose states are kept before marked bytes are looked for.
LANE = 512
STEPS = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``pattern`` is matched greedily; a match counts where what follows ``lead``
    (an expression that matches its beginning; empty: the whole match) has ``least`` characters."""

    kind: str
    pattern: str
    least: int = 1
    lead: str = ""
    ignore_case: bool = False


# The three base rules, and public formats of tokens and keys. Where a match is a run that nothing
# may follow, the least length stands in the pattern, which marks fewer bytes and gives the same matches.
_KEYWORD = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
BASE = (
    Rule("assign", _KEYWORD + "[A-Za-z0-9+/_.=-]+", 6, _KEYWORD, ignore_case=True),
    Rule("access", "AKIA[A-Z0-9]+", 20),
    Rule("hex", "[0-9a-f]{24,}", 24),
)
RULES = BASE + (
    Rule("github", "gh[opsur]_[A-Za-z0-9]+", 40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule("private_key", "-----BEGIN ([A-Z]+ )*PRIVATE KEY-----"),
)


class Scanner:
    """The compiled rules."""

    def __init__(self, rules: tuple[Rule, ...]):
        trees = [automata.read(rule.pattern, rule.ignore_case) for rule in rules]
        self.rules = rules
        self.back = automata.compile_rules([automata.mirrored(tree) for tree in trees], anywhere=True)
        self.pairs = automata.forgetting_pairs(self.back)
        self.ahead = [automata.compile_rules([tree], anywhere=False) for tree in trees]
        self.leads = [automata.compile_rules([automata.read(r.lead, r.ignore_case)], anywhere=False) for r in rules]

    def lanes(self, kinds: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lanes (low, high, state before the byte high - 1) that cover all texts."""
        low, high = starts[ends > starts], ends[ends > starts]
        if len(kinds) > 1 and len(low):
            after = self.pairs[kinds[1:], kinds[:-1]]  # read backwards: the byte at p + 1, then the one at p
            free = after >= 0
            free[high[high < len(kinds)] - 1] = False  # those two bytes belong to two texts
            cuts = np.flatnonzero(free)
            cuts = cuts[(cuts >= low[0]) & (cuts < high[-1])]
            owner = np.searchsorted(high, cuts, side="right")
            inner = cuts > low[owner]
            cuts, owner = cuts[inner], owner[inner]
            bucket = (cuts - low[owner]) // LANE
            fresh = np.ones(len(cuts), bool)
            fresh[1:] = (owner[1:] != owner[:-1]) | (bucket[1:] != bucket[:-1])
            cuts = cuts[fresh]
            ends_of = np.unique(np.concatenate([high, cuts]))
            begins_at = np.unique(np.concatenate([low, cuts]))
            state = np.where(np.isin(ends_of, cuts), after[np.minimum(ends_of, len(after) - 1)], self.back.start)
            return begins_at, ends_of, state.astype(np.int32)
        return low, high, np.full(len(low), self.back.start, np.int32)

    def marks(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(byte, rules as bits) wherever a match begins, ascending."""
        machine = self.back
        kinds = machine.of_byte[data]
        low, high, state = self.lanes(kinds, starts, ends)
        order = np.argsort(low - high, kind="stable")  # longest lane first
        low, at, state = low[order], high[order] - 1, state[order]
        length = at + 1 - low
        found = []
        done, longest = 0, int(length[0]) if len(length) else 0
        while done < longest:
            steps = min(STEPS, longest - done)
            live = int(np.searchsorted(-length, -done, side="left"))
            seen = np.zeros((steps, live), np.int32)
            for k in range(steps):
                n = int(np.searchsorted(-length, -(done + k), side="left"))
                moved = machine.step[state[:n] * machine.classes + kinds[at[:n] - (done + k)]]
                state[:n] = moved
                seen[k, :n] = moved
                if n < live:
                    seen[k, n:] = -1
            step, lane = np.nonzero(seen >= machine.first_accepting)
            if len(step):
                found.append((at[lane] - (done + step), machine.accepts[seen[step, lane]]))
            done += steps
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        place = np.concatenate([p for p, _ in found])
        bits = np.concatenate([b for _, b in found])
        order = np.argsort(place)
        return place[order], bits[order]

    def spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[list[tuple[int, int, int]]]:
        """Per text: (start, rule, end) in bytes of the text, sorted."""
        found: list[list[tuple[int, int, int]]] = [[] for _ in starts]
        place, bits = self.marks(data, starts, ends)
        owner = np.searchsorted(starts, place, side="right") - 1
        free = np.zeros((len(self.rules),), np.int64)  # matches of a rule go on from here
        for p, mask, text in zip(place.tolist(), bits.tolist(), owner.tolist(), strict=True):
            for k, rule in enumerate(self.rules):
                if not mask >> k & 1 or p < free[k]:
                    continue
                end = _longest(self.ahead[k], data, p, int(ends[text]))
                free[k] = end
                lead = _longest(self.leads[k], data, p, end) if rule.lead else p
                if end - lead >= rule.least:
                    found[text].append((p - int(starts[text]), k, end - int(starts[text])))
        return found


def _longest(machine: automata.Automaton, data: np.ndarray, at: int, end: int) -> int:
    """The end of the longest match that begins at ``at``; ``at`` where there is none."""
    state, best = machine.start, at
    for p in range(at, end):
        state = int(machine.step[state * machine.classes + int(machine.of_byte[data[p]])])
        if state == machine.dead:
            break
        if state >= machine.first_accepting:
            best = p + 1
    return best


FOUND = "array<struct<kind string, start long, end long>>"


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``row`` (all columns but the text) and ``found``: the spans of every row's whole text."""
    common.prepare(docs.sparkSession)
    scanner = Scanner(rules)  # compiled once; the arrays travel with the task
    kept = [F.col(f"`{c}`") for c in docs.columns if c != text]
    given = docs.select((F.struct(*kept) if kept else F.struct(F.lit(None).alias("none"))).alias("row"), F.col(f"`{text}`").alias("text"))

    def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            column = batch.column("text").cast(pa.large_binary()).fill_null(b"")
            bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
            body = column.buffers()[2]
            data = np.frombuffer(body, np.uint8) if body is not None else np.empty(0, np.uint8)
            found = []
            for i, spans in enumerate(scanner.spans(data, bounds[:-1], bounds[1:]) if len(column) else []):
                if spans:
                    points = np.concatenate([[0], np.cumsum((data[bounds[i] : bounds[i + 1]] & 0xC0) != 0x80)])
                    spans = [{"kind": rules[k].kind, "start": int(points[a]), "end": int(points[b])} for a, k, b in sorted(spans)]
                found.append(spans)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, kind)], ["row", "found"])

    return given.mapInArrow(scan_batches, f"row {given.schema['row'].dataType.simpleString()}, found {FOUND}")


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text of ``documents``: counts and digest of the base rules, and all spans."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    base = ", ".join(f"'{rule.kind}'" for rule in BASE)
    line = "x -> concat(x.kind, ':', x.start, ':', x.end)"
    return scan(docs).select(
        F.col("row.doc_id").alias("doc_id"),
        *(F.expr(f"cast(size(filter(found, x -> x.kind = '{rule.kind}')) as bigint)").alias(f"n_{rule.kind}") for rule in BASE),
        F.expr(f"sha2(concat_ws(',', transform(filter(found, x -> x.kind in ({base})), {line})), 256)").alias("base_sha256"),
        F.expr(f"concat_ws(',', transform(found, {line}))").alias("spans"),
    )
