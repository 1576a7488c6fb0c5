"""Chat formatting: roles of transcript lines by a hidden Markov model (operator 8).

A transcript is plain text whose lines may or may not start with a speaker marker
("User:", "### Assistant", "> "). Each line is observed through its marker kind,
length, ending and the blank line before it. The hidden state is a role with
whether the line opens a turn; the likeliest state sequence (Viterbi) gives the
turns, rendered as ``<|im_start|>role``, the text without marker, ``<|im_end|>``.

The model is counted from labelled conversations by Spark; only the counts (states
times observation values) reach the driver.

A conversation may be longer than a task can hold. Its lines are cut into chunks;
each chunk gives the best log-probability from every state before it to every
state at its end, these small matrices are chained per conversation, and each
chunk is then decoded between the two states found. This is exact, since the
best paths compose.

Defined results: a null text has no lines, so a conversation whose texts are all null
has no row; an empty text is a blank line; parts go in order of part, then text; a null part comes last; a row with a null conversation is a
conversation of its own; repeated rows are repeated parts; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.tables import Scratch

ROLES = ("system", "user", "assistant")
STATES, START = 2 * len(ROLES), 2 * len(ROLES)  # state 2 * role opens a turn, 2 * role + 1 continues it
#: Lines of a chunk, and parts of a conversation that are sorted together.
CHUNK_LINES, BLOCK_PARTS = 4096, 256

_NAMES = {
    "user": "user human customer q question prompt me",
    "assistant": "assistant ai bot model a answer response gpt",
    "system": "system instructions instruction context",
}
_KIND_OF = {name: ROLES.index(role) + 1 for role, names in _NAMES.items() for name in names.split()}
_MARKER = re.compile(r"^\s*(?:#{1,6}\s*|\*\*|\[|<\|?)?\s*([A-Za-z]{1,12})\s*(?:\*\*)?\s*(?:[:\]>]|\|>|$)(?:\*\*)?\s*")
_HEADING = re.compile(r"^\s*(?:#{1,6}|\*\*|\[|<)")
#: Values of each observation: marker (none, three roles, quote, blank), length, ending, after a blank line.
VALUES = (6, 6, 4, 2)


def marker_of(line: str) -> tuple[int, int]:
    """(marker kind, characters of the marker)."""
    if not line.strip():
        return 5, 0
    if line.startswith("> "):
        return 4, 2
    found = _MARKER.match(line)
    if found:
        kind = _KIND_OF.get(found[1].lower(), 0)
        ends_line = found.end() == len(line) and not found[0].rstrip().endswith((":", "]", ">"))
        if kind and (not ends_line or _HEADING.match(line)):
            return kind, found.end()
    return 0, 0


def observed(lines: list[str], after_blank: bool = False) -> np.ndarray:
    """One row of observation values per line."""
    out = np.zeros((len(lines), len(VALUES)), dtype=np.int64)
    for i, line in enumerate(lines):
        kind, used = marker_of(line)
        text = line[used:].rstrip()
        size = len(text)
        length = 0 if not size else 1 + (size > 60) + (size > 160) + (size > 400) + (size > 1000)
        ending = 0 if not size else 1 if text[-1] == "?" else 2 if text[-1] in ".!" else 3
        out[i] = kind, length, ending, after_blank
        after_blank = kind == 5
    return out


class Model:
    """Log-probabilities: ``step`` (7 x 6, the last row starts a transcript) and one table per observation."""

    def __init__(self, step: np.ndarray, emit: list[np.ndarray]) -> None:
        with np.errstate(divide="ignore"):
            self.step = np.log(step / step.sum(axis=1, keepdims=True))
            self.emit = [np.log(e / e.sum(axis=1, keepdims=True)) for e in emit]

    def line_scores(self, obs: np.ndarray) -> np.ndarray:
        return sum(e[:, obs[:, i]].T for i, e in enumerate(self.emit))

    def transfer(self, scores: list[np.ndarray]) -> np.ndarray:
        """For each chunk: the best score from each state before it (7) to each last state (6)."""
        out = np.full((len(scores), STATES + 1, STATES), -np.inf)
        for active, emitted, first in _steps(scores):
            if first:
                out[active] = self.step[None] + emitted[:, None, :]
            else:
                best = (out[active][:, :, :, None] + self.step[None, None, :STATES, :]).max(axis=2)
                out[active] = best + emitted[:, None, :]
        return out

    def decode(self, scores: list[np.ndarray], before: np.ndarray, last: np.ndarray) -> list[np.ndarray]:
        """The best states of each chunk between the state before it and its last state."""
        value = np.zeros((len(scores), STATES))
        came = []
        for active, emitted, first in _steps(scores):
            if first:
                value[active] = self.step[before[active]] + emitted
                came.append((active, np.zeros((len(active), STATES), dtype=np.int64)))
            else:
                every = value[active][:, :, None] + self.step[None, :STATES, :]
                came.append((active, every.argmax(axis=1)))
                value[active] = every.max(axis=1) + emitted
        out = [np.zeros(len(s), dtype=np.int64) for s in scores]
        state = last.copy()
        for t in range(len(came) - 1, -1, -1):
            active, back = came[t]
            for i, at in enumerate(active):
                out[at][t] = state[at]
                state[at] = back[i, state[at]]
        return out


def _steps(scores: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """All chunks line by line: the chunks that have a t-th line, and its scores."""
    sizes = np.array([len(s) for s in scores], dtype=np.int64)
    order = np.argsort(-sizes, kind="stable")
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else sizes
    flat = np.concatenate(scores) if scores else np.zeros((0, STATES))
    for t in range(int(sizes.max(initial=0))):
        active = order[: np.searchsorted(-sizes[order], -t, side="left")]
        yield active, flat[starts[active] + t], t == 0


def written(conversations: DataFrame) -> DataFrame:
    """(conv_id, part, role, text): turns written with the markers of one of five styles.

    About one turn in twelve loses its marker. The style is drawn from the id.
    """
    style = F.pmod(F.xxhash64("conv_id"), F.lit(5))
    unmarked = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(12)) == 0
    names = (
        ("System: ", "User: ", "Assistant: "),
        ("Instructions: ", "Human: ", "AI: "),
        ("### System\n", "### User\n", "### Assistant\n"),
        ("Context: ", "Q: ", "A: "),
        ("[system] ", "> ", ""),
    )
    marker = F.lit("")
    for s, row in enumerate(names):
        for role, text in zip(ROLES, row, strict=True):
            marker = F.when((style == s) & (F.col("role") == role), F.lit(text)).otherwise(marker)
    marker = F.when(unmarked, F.lit("")).otherwise(marker)
    return conversations.select("conv_id", F.col("turn").cast("long").alias("part"), "role", F.concat(marker, F.col("text")).alias("text"))


def transcripts(conversations: DataFrame) -> DataFrame:
    """(conv_id, part, text): conversations as plain transcripts, without the roles."""
    return written(conversations).drop("role")


def learn_from_conversations(conversations: DataFrame) -> Model:
    """Counts the model from the conversations whose crc32 is not 1 modulo 3."""
    rows = written(conversations).where(F.col("role").isin(*ROLES) & F.col("text").isNotNull() & F.col("conv_id").isNotNull())
    rows = rows.where(F.crc32(F.col("conv_id").cast("string").cast("binary")) % 3 != 1)
    several = F.instr("text", "\n") > 0
    earlier = rows.select(F.col("conv_id").alias("c"), (F.col("part") + 1).alias("p"), F.col("role").alias("earlier"), several.alias("several"))
    earlier = earlier.groupBy("c", "p").agg(F.min("earlier").alias("earlier"), F.max("several").alias("several"))
    pairs = rows.join(earlier, (F.col("conv_id") == F.col("c")) & (F.col("part") == F.col("p")), "left")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = np.zeros((STATES + 1, STATES), dtype=np.int64)
            emit = [np.zeros((STATES, v), dtype=np.int64) for v in VALUES]
            for role, text, earlier, several in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                lines = text.split("\n")
                open_ = 2 * ROLES.index(role)
                step[START if earlier is None else 2 * ROLES.index(earlier) + bool(several), open_] += 1
                if len(lines) > 1:
                    step[open_, open_ + 1] += 1
                    step[open_ + 1, open_ + 1] += len(lines) - 2
                obs = observed(lines)
                states = np.full(len(lines), open_ + 1)
                states[0] = open_
                for i, table in enumerate(emit):
                    np.add.at(table, (states, obs[:, i]), 1)
            found = [(k, a, b, int(t[a, b])) for k, t in [(-1, step), *enumerate(emit)] for a, b in np.argwhere(t).tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[i] for f in found], type=pa.int64()) for i in range(4)], ["kind", "a", "b", "n"]
            )

    counted = pairs.select("role", "text", "earlier", "several").mapInArrow(count, "kind long, a long, b long, n long")
    step = np.full((STATES + 1, STATES), 0.5)
    for a in range(STATES + 1):
        for b in range(1, STATES, 2):  # only a turn itself can be continued
            if a == START or a // 2 != b // 2:
                step[a, b] = 0.0
    emit = [np.full((STATES, v), 0.5) for v in VALUES]
    for r in counted.groupBy("kind", "a", "b").agg(F.sum("n").alias("n")).collect():  # states x values rows
        (step if r["kind"] < 0 else emit[r["kind"]])[r["a"], r["b"]] += r["n"]
    return Model(step, emit)


CHUNKS = "conv_id long, solo long, block long, chunk long, lines array<string>, transfer array<double>"


def chunked(parts: DataFrame, model: Model) -> DataFrame:
    """Lines of each conversation in chunks, and each chunk's transfer scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, chunk, lines = None, 0, []
        done: list[tuple] = []

        def taken() -> pa.RecordBatch:
            scores = [model.line_scores(observed(d[4])) for d in done]
            transfer = model.transfer(scores).reshape(len(done), -1) if done else np.zeros((0, 1))
            columns = [pa.array([d[i] for d in done], type=t) for i, t in enumerate([pa.int64()] * 4 + [pa.list_(pa.string())])]
            out = pa.RecordBatch.from_arrays(
                [*columns, pa.array(transfer.tolist(), type=pa.list_(pa.float64()))], ["conv_id", "solo", "block", "chunk", "lines", "transfer"]
            )
            done.clear()
            return out

        for batch in batches:
            for conv_id, solo, block, text in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                if (conv_id, solo, block) != group:
                    if lines:
                        done.append((*group, chunk, lines))
                    group, chunk, lines = (conv_id, solo, block), 0, []
                lines.extend(text.split("\n"))
                while len(lines) > CHUNK_LINES:
                    done.append((*group, chunk, lines[:CHUNK_LINES]))
                    chunk, lines = chunk + 1, lines[CHUNK_LINES:]
            yield taken()
        if lines:
            done.append((*group, chunk, lines))
        yield taken()

    return parts.mapInArrow(run, CHUNKS)


def bounded(chunks: DataFrame) -> DataFrame:
    """The states before and at the end of each chunk on the best path of its conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: tuple | None = None
        held: list[tuple[int, int, np.ndarray]] = []
        out: list[tuple] = []

        def close() -> None:
            if not held:
                return
            value, came = held[0][2][START], []
            for _, _, m in held[1:]:
                every = value[:, None] + m[:STATES]
                came.append(every.argmax(axis=0))
                value = every.max(axis=0)
            state = int(value.argmax())
            states = [state]
            for back in reversed(came):
                states.append(state := int(back[state]))
            states.reverse()
            for i, (block, chunk, _) in enumerate(held):
                out.append((*group, block, chunk, states[i - 1] if i else START, states[i], int(i + 1 == len(held))))
            held.clear()

        def taken() -> pa.RecordBatch:
            names = ["conv_id", "solo", "block", "chunk", "before", "last", "ends"]
            made = pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], type=pa.int64()) for i in range(7)], names)
            out.clear()
            return made

        for batch in batches:
            for conv_id, solo, block, chunk, transfer in zip(*[batch.column(i).to_pylist() for i in range(5)], strict=True):
                if (conv_id, solo) != group:
                    close()
                    group = (conv_id, solo)
                held.append((block, chunk, np.array(transfer).reshape(STATES + 1, STATES)))
            yield taken()
        close()
        yield taken()

    return chunks.mapInArrow(run, "conv_id long, solo long, block long, chunk long, before long, last long, ends long")


def rendered(chunks: DataFrame, model: Model) -> DataFrame:
    """Each chunk's turns in canonical form; the chunks of a conversation follow on from each other."""

    def text_of(lines: list[str], states: np.ndarray, first: bool, ends: bool) -> tuple[int, str, str]:
        out, roles = [], []
        for i, (line, state) in enumerate(zip(lines, states.tolist(), strict=True)):
            if state % 2 == 0:
                roles.append(ROLES[state // 2])
                if not (first and i == 0):
                    out.append("<|im_end|>")
                out.append(f"<|im_start|>{roles[-1]}")
                line = line[marker_of(line)[1] :]
                if not line and marker_of(lines[i])[0]:
                    continue  # a heading of its own line
            out.append(line)
        if ends:
            out.append("<|im_end|>")
        return len(roles), ",".join(roles), "\n".join(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            conv_id, block, chunk, lines, before, last, ends = (batch.column(i).to_pylist() for i in range(7))
            scores = [model.line_scores(observed(x)) for x in lines]
            states = model.decode(scores, np.array(before, dtype=np.int64), np.array(last, dtype=np.int64))
            made = [text_of(*x) for x in zip(lines, states, [b == START for b in before], ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(c, type=pa.int64()) for c in (conv_id, block, chunk, map(len, lines), [m[0] for m in made])],
                 pa.array([m[1] for m in made], type=pa.string()), pa.array([m[2] for m in made], type=pa.string())],
                ["conv_id", "block", "chunk", "n_lines", "n_turns", "roles", "rendered"],
            )

    return chunks.mapInArrow(run, "conv_id long, block long, chunk long, n_lines long, n_turns long, roles string, rendered string")


def format_transcripts(parts: DataFrame, model: Model) -> DataFrame:
    """(conv_id, block, chunk, n_lines, n_turns, roles, rendered) from (conv_id, part, text).

    A conversation of up to BLOCK_PARTS parts and CHUNK_LINES lines is one row; a
    longer one is a row per chunk, to be read in the order of block and chunk.
    """
    spark = parts.sparkSession
    scratch = Scratch(spark, "chat")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = parts.where(F.col("text").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()).otherwise(-1).alias("solo"),
        F.coalesce(F.col("part").cast("long"), F.lit(1 << 50) + F.pmod(F.xxhash64("text"), F.lit(1 << 40))).alias("part"),
        F.col("text").cast("string").alias("text"),
    )
    rows = rows.withColumn("block", F.floor(F.col("part") / BLOCK_PARTS).cast("long"))
    key = ["conv_id", "solo", "block"]
    ordered = rows.repartition(n, *key).sortWithinPartitions(*key, "part", "text").select(*key, "text")
    chunks = scratch.write(chunked(ordered, model), "chunks")
    chain = chunks.select(*key, "chunk", "transfer").repartition(n, "conv_id", "solo").sortWithinPartitions(*key, "chunk")
    ends = scratch.write(bounded(chain).select(*[F.col(c).alias(f"e_{c}") for c in (*key, "chunk")], "before", "last", "ends"), "ends")
    same = F.col("conv_id").eqNullSafe(F.col("e_conv_id"))
    for c in ("solo", "block", "chunk"):
        same &= F.col(c) == F.col(f"e_{c}")
    both = chunks.join(ends, same).select("conv_id", "block", "chunk", "lines", "before", "last", "ends")
    return rendered(both, model)
