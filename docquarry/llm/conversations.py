"""Conversation structure repair by a forward Viterbi search for each conversation.

A well-formed conversation is empty, or a system turn (which may be missing) and
then user and assistant in turn: four grammar states (nothing yet, after system,
after user, after assistant).  A conversation's rows come sorted, and a layer
holds for each state the cheapest edits that lead there: (cost, audit string),
ties to the least string.  A row is kept, given the role that the state expects,
or deleted; blank rows and repetitions have to be deleted, and a truncated row
that stays costs one more.  Each layer is closed with insertions, two in a row at
most, as two lead from any state to any state that insertions reach.

Two audits of one state with equal costs are never one the other's beginning
(what is longer by insertions alone costs more), so the least beginning stays the
least with whatever follows, and the search is exact.

Bounded memory: conversations are dealt out by id and sorted, and rows run
through the search one after another, so a conversation is never held whole.  A
state carries a running digest of its repaired turns; what all audits begin with
is set aside from time to time, and states that can't win any more are left out.
Whether a turn was said before is found by a grouped minimum and a join whose
skewed keys Spark can split.  The digest of a conversation is one chain over its
bytes, so a conversation is one task's work, however long it is.

Defined results: a null conversation id is an id; null roles and texts are one
space (so such a text is blank, such a role can't be kept); null turns come
first; rows of one turn are in order of role and text; an empty role can't be
kept; an empty table gives an empty table; other columns, whatever their names,
are ignored.
"""

from __future__ import annotations

import hashlib
import os.path
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches

#: Grammar states.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where a kept row leads, by state and the role's initial.
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
#: Costs of edits.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
SPACES, STOPS = " \t\n\x0b\x0c\r", ".!?"
#: Rows between two looks for what all audits begin with.
SETTLE = 64


def _next(state: int) -> int:
    """Where the turn that a state expects leads."""
    return ASSISTANT if state == USER else USER


def _dominated(layer: dict) -> dict:
    """A layer without states that can't win: whatever follows an empty beginning can follow an assistant's turn for at most
    a deletion (of a system turn) more, and whatever follows a system turn for nothing more."""
    least = layer[ASSISTANT][0]
    return {s: x for s, x in layer.items() if not (s == START and x[0] > least + DELETE or s == SYSTEM and x[0] > least)}


class Search:
    """The layer of the rows so far: cost, open end of the audit, and running digest for each state."""

    def __init__(self) -> None:
        self.settled: list[str] = []
        self.rows = 0
        self.layer = self._closed({START: (0, "", hashlib.sha256())})

    @staticmethod
    def _offer(layer: dict, state: int, cost: int, audit: str, told: object) -> None:
        if state not in layer or (cost, audit) < layer[state][:2]:
            layer[state] = (cost, audit, told)

    @staticmethod
    def _digest(told: object) -> object:
        """The running digest that an offer stands for: one as it is, or one with a turn more."""
        if not isinstance(told, tuple):
            return told
        before, first, turn = told
        digest = before.copy()
        digest.update(turn if first else b"\n" + turn)
        return digest

    def _closed(self, layer: dict) -> dict:
        for _ in range(2):
            layer = {s: (c, a, self._digest(d)) for s, (c, a, d) in layer.items()}
            for s, (c, a, d) in list(layer.items()):
                to = _next(s)
                self._offer(layer, to, c + INSERT, a + "I", (d, s == START, NAMES[to].encode() + b":"))
        return _dominated({s: (c, a, self._digest(d)) for s, (c, a, d) in layer.items()})

    def add(self, role: str, text: str, unusable: bool, truncated: bool) -> None:
        layer: dict = {}
        said = b":" + text.encode("utf-8", "surrogatepass")
        for s, (c, a, d) in self.layer.items():
            self._offer(layer, s, c + DELETE, a + "D", d)
            if unusable:
                continue
            extra = TRUNCATED * truncated
            if (s, role[:1]) in KEPT:
                self._offer(layer, KEPT[s, role[:1]], c + extra, a + "K", (d, s == START, role.encode() + said))
            to = _next(s)
            self._offer(layer, to, c + REROLE + extra, a + "R", (d, s == START, NAMES[to].encode() + said))
        self.layer = self._closed(layer)
        self.rows += 1
        if self.rows % SETTLE == 0:
            common = os.path.commonprefix([a for _, a, _ in self.layer.values()])
            self.settled.append(common)
            self.layer = {s: (c, a[len(common) :], d) for s, (c, a, d) in self.layer.items()}

    def end(self) -> tuple[int, str, str]:
        """Cost, audit and digest of the cheapest well-formed end."""
        cost, audit, digest = min((self.layer[s] for s in (START, ASSISTANT) if s in self.layer), key=lambda x: x[:2])
        return cost, "".join(self.settled) + audit, digest.hexdigest()


@dataclass
class Tally:
    """What is counted of one conversation as its rows go by."""

    search: Search = field(default_factory=Search)
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first: int | None = None
    last: int | None = None
    turns: int = 0
    before: tuple | None = None

    def add(self, turn: int | None, role: str, text: str, again: bool) -> None:
        again = again or self.before == (turn, role, text)
        end = text.rstrip(SPACES)[-1:]
        blank, truncated = not end, end not in STOPS
        self.blank += blank
        self.duplicate += not blank and again
        self.truncated += not blank and not again and truncated
        if self.before is not None:
            self.illegal += self.before[1][:1] + role[:1] not in LEGAL
        if turn is not None:
            self.first = turn if self.first is None else self.first
            self.turns += turn != self.last
            self.last = turn
        self.before = turn, role, text
        self.search.add(role, text, blank or again, truncated)

    def row(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, *self.search.end()


REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def _plain(df: DataFrame, id_column: str, turn_column: str, role_column: str, text_column: str) -> DataFrame:
    """``conv, turn, role, text`` without nulls in the last two."""
    filled = lambda name: F.coalesce(df[name].cast("string"), F.lit(" "))
    return df.select(df[id_column].alias("conv"), df[turn_column].cast("long").alias("turn"), filled(role_column).alias("role"), filled(text_column).alias("text"))


def damage(df: DataFrame, *, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text") -> DataFrame:
    """``conv, turn, role, text`` of ``df``'s rows with faults planted by a checksum of id and turn: of 20 parts one is dropped,
    one emptied, one stripped of its sentence ends, one repeated, and one given to the user."""
    rows = _plain(df, id_column, turn_column, role_column, text_column)
    key = F.concat_ws(":", F.coalesce(F.col("conv").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = rows.withColumn("part", F.crc32(key) % 20).where("part <> 0")
    rows = rows.withColumn("text", F.when(F.col("part") == 1, "").when(F.col("part") == 2, F.translate("text", STOPS, "")).otherwise(F.col("text")))
    rows = rows.withColumn("role", F.when(F.col("part") == 4, "user").otherwise(F.col("role")))
    return rows.withColumn("copy", F.explode(F.expr("if(part = 3, array(0, 1), array(0))"))).select("conv", "turn", "role", "text")


def _told(rows: DataFrame) -> DataFrame:
    """``rows`` with ``again``: whether the role and text were there in an earlier turn of the conversation."""
    rows = rows.withColumn("said", F.md5("text"))
    firsts = rows.groupBy("conv", "role", "said").agg(F.count("*").alias("n"), F.min("turn").alias("first"), F.bool_or(F.col("turn").isNull()).alias("unnumbered")).where("n > 1")
    firsts = firsts.select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("said").alias("s"), "first", "unnumbered")
    same = rows["conv"].eqNullSafe(firsts["c"]) & (rows["role"] == firsts["r"]) & (rows["said"] == firsts["s"])
    joined = rows.join(firsts, same, "left")
    return joined.select("conv", "turn", "role", "text", F.coalesce(F.col("unnumbered") & F.col("turn").isNotNull() | (F.col("turn") > F.col("first")), F.lit(False)).alias("again"))


def _sorted(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """Rows sorted by conversation, each after its head (``conv, text``), which has no role."""
    bound_batches(rows.sparkSession)
    heads = heads.select("conv", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), "text", F.lit(False).alias("again"))
    both = heads.unionByName(rows).repartition("conv")
    return both.sortWithinPartitions("conv", F.col("role").isNotNull(), F.col("turn").asc_nulls_first(), "role", "text")


def repair(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """Faults, cost, audit and the repaired text's digest for each conversation of ``conversations`` (conv).

    ``rows`` (conv, turn, role, text) has no nulls in role and text; a conversation without rows is well-formed.
    """
    heads = conversations.select("conv").distinct().withColumn("text", F.lit(""))
    kind = dict(heads.dtypes)["conv"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tally = None, None
        for batch in batches:
            done = []
            for conv, turn, role, text, again in zip(*(c.to_pylist() for c in batch.columns)):
                if role is None:  # the next conversation's head
                    if tally is not None:
                        done.append((now, *tally.row()))
                    now, tally = conv, Tally()
                else:
                    tally.add(turn, role, text, again)
            yield _batch(done, batch.schema.field(0).type)
            last = batch.schema.field(0).type
        if tally is not None:
            yield _batch([(now, *tally.row())], last)

    return _sorted(_told(rows), heads).mapInArrow(run, f"conv {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    kinds = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["conv", *REPORT])


def repaired(rows: DataFrame, report: DataFrame) -> DataFrame:
    """``conv, place, role, text, edit``: the turns of the repaired conversations, by the audits of ``report``."""
    heads = report.select("conv", F.col("audit").alias("text"))
    kind = dict(heads.dtypes)["conv"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, at, place, state = None, "", 0, 0, START
        for batch in batches:
            done = []

            def put(role: str, text: str, edit: str) -> None:
                nonlocal place, state
                state = KEPT[state, role[:1]]
                done.append((conv, place, role, text, edit))
                place += 1

            def inserted() -> None:
                nonlocal at
                while audit[at : at + 1] == "I":
                    at += 1
                    put(NAMES[_next(state)], "", "I")

            for c, role, text in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3))):
                if role is None:
                    conv, audit, at, place, state = c, text, 0, 0, START
                else:
                    edit = audit[at]
                    at += 1
                    if edit != "D":
                        put(role if edit == "K" else NAMES[_next(state)], text, edit)
                inserted()
            kinds = [batch.schema.field(0).type, pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], t) for k, t in enumerate(kinds)], ["conv", "place", "role", "text", "edit"])

    rows = rows.select("conv", "turn", "role", "text", F.lit(False).alias("again"))
    return _sorted(rows, heads).mapInArrow(run, f"conv {kind}, place long, role string, text string, edit string")


def damaged_and_repaired(df: DataFrame, *, id_column: str = "conv_id", **columns) -> DataFrame:
    """The report of ``df``'s conversations after planted damage, one row for each id."""
    found = repair(damage(df, id_column=id_column, **columns), df.select(df[id_column].alias("conv")))
    return found.select(F.col("conv").alias(id_column), *REPORT)
