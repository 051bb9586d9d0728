"""Chat formatting: roles of transcript lines by a hidden Markov model, and canonical turns.

A transcript is a sequence of lines. Each line has a marker (a speaker's name or
sign at its start, or none) and line features (length, question mark, first
line). Hidden states are a role and whether the line begins a turn; their
transition and emission probabilities are counts over labelled transcripts.
Viterbi's best path gives roles and turns, and each line is rendered in a
canonical form: a header where a turn begins, an end mark where it ends.

A long transcript is no long task: it is cut into blocks of consecutive lines.
Max-plus products make a block a matrix of best scores from state to state, a scan
over a transcript's blocks fixes the states at their borders, and each block is then
decoded alone, with the same path as the whole would have.

Defined results: a null text is an empty line; a row without a conversation id is a
conversation of its own; a null turn comes first; rows of the same turn are ordered by
a hash of their number in the table. Among equal scores a best path is taken. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linefold.llm.common import materialize, ship, text_of

ROLES = ("system", "user", "assistant")
#: (role, begins a turn)
STATES = tuple((r, b) for r in ROLES for b in (True, False))
#: Markers at the start of a line, by class; class 0 is none, 4 an unknown speaker.
MARKERS = (
    r"(?i)^\s*(?:system\s*:|<<SYS>>|\[system\]|instructions?\s*:)",
    r"(?i)^\s*(?:user\s*:|human\s*:|q\s*:|customer\s*:|me\s*:|<\|user\|>|\[INST\]|###\s*instruction\s*:?)",
    r"(?i)^\s*(?:assistant\s*:|ai\s*:|a\s*:|bot\s*:|agent\s*:|<\|assistant\|>|\[/INST\]|###\s*response\s*:?)",
    r"^\s*\p{L}[\p{L}\p{N}_-]{0,20}\s*:",
)
N_MARKERS = len(MARKERS) + 1
#: Upper ends of the length classes, in characters.
LENGTHS = (20, 80, 200, 500)
N_SHAPES = (len(LENGTHS) + 1) * 2 * 2
BLOCK = 1024
SMOOTHING = 0.5


def marker_class(line: Column) -> Column:
    out = F.when(line.rlike(MARKERS[0]), 1)
    for k, pattern in enumerate(MARKERS[1:], 2):
        out = out.when(line.rlike(pattern), k)
    return out.otherwise(0)


def shape_class(line: Column, first: Column) -> Column:
    """Length class, question mark at the end, first line of its transcript: one number below ``N_SHAPES``."""
    n = F.char_length(line)
    size = sum((n > x).cast("int") for x in LENGTHS)
    return size * 4 + line.rlike(r"\?\s*$").cast("int") * 2 + first.cast("int")


def without_marker(line: Column, marker: Column) -> Column:
    out = F.when(marker == 1, F.regexp_replace(line, MARKERS[0] + r"\s*", ""))
    for k, pattern in enumerate(MARKERS[1:], 2):
        out = out.when(marker == k, F.regexp_replace(line, pattern + r"\s*", ""))
    return out.otherwise(line)


@dataclass
class Model:
    """Log probabilities: of the first state, of state after state, of marker and shape given the state."""

    start: np.ndarray
    step: np.ndarray
    marker: np.ndarray
    shape: np.ndarray

    def emission(self, markers: np.ndarray, shapes: np.ndarray) -> np.ndarray:
        return self.marker[:, markers].T + self.shape[:, shapes].T

    def transfer(self, emission: np.ndarray) -> np.ndarray:
        """Best score of a block from each state before its first line to each state at its last."""
        m = np.full((len(STATES), len(STATES)), -np.inf)
        np.fill_diagonal(m, 0.0)
        for e in emission:
            m = (m[:, :, None] + self.step[None, :, :]).max(axis=1) + e
        return m

    def decode(self, emission: np.ndarray, before: int | None = None, last: int | None = None) -> list[int]:
        """Best path through lines that follow the state ``before`` (none: a transcript's first lines) and end in ``last``."""
        score = (self.start if before is None else self.step[before]) + emission[0]
        back = []
        for e in emission[1:]:
            both = score[:, None] + self.step
            back.append(both.argmax(axis=0))
            score = both.max(axis=0) + e
        path = [int(score.argmax()) if last is None else last]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        return path[::-1]

    def first_scores(self, emission: np.ndarray) -> np.ndarray:
        """Scores of the states at the end of a transcript's first block."""
        score = self.start + emission[0]
        for e in emission[1:]:
            score = (score[:, None] + self.step).max(axis=0) + e
        return score


def _normal(x: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log(x / x.sum(axis=-1, keepdims=True))


def lines_of(rows: DataFrame, conv_col: str, turn_col: str, text_col: str, keep: list[str] | None = None) -> DataFrame:
    """Lines of transcripts: ``conv, turn, tie, at, line, marker, shape`` and the columns ``keep``.

    Rows are ordered by ``turn`` and, where they share one, by a hash of their number in the table.
    """
    r = rows.select(
        F.col(conv_col).cast("string").alias("conv"),
        F.coalesce(F.col(turn_col).cast("long"), F.lit(-1)).alias("turn"),
        F.monotonically_increasing_id().alias("number"),
        text_of(F.col(text_col)).alias("text"),
        *(keep or []),
    )
    own = F.concat(F.lit("\x00row "), F.col("number").cast("string"))  # no id: a conversation of its own
    r = r.withColumns({"conv": F.coalesce("conv", own), "tie": F.xxhash64("number")})
    lines = r.select("conv", "turn", "tie", *(keep or []), F.posexplode(F.split("text", r"\r?\n")).alias("at", "line"))
    first = (F.col("at") == 0) & (F.col("turn") <= 0)
    return lines.withColumns({"marker": marker_class(F.col("line")), "shape": shape_class(F.col("line"), first)})


def fit(labelled: DataFrame, role_col: str = "role", smoothing: float = SMOOTHING) -> Model:
    """Count transitions and emissions over lines with a role; one table of fixed size comes to the driver.

    The line before the first of a turn is the last of the turn before, found by an equi-join on its number.
    """
    known = labelled.filter(F.col(role_col).isin(*ROLES))
    role = F.array_position(F.array(*[F.lit(r) for r in ROLES]), F.col(role_col)).cast("int") - 1
    known = known.withColumn("state", role * 2 + (F.col("at") > 0).cast("int")).withColumn("role_", role)
    turns = known.groupBy("conv", (F.col("turn") + 1).alias("turn")).agg(
        F.min("role_").alias("r"), F.max("at").alias("last")
    )
    before = turns.select("conv", "turn", (F.col("r") * 2 + (F.col("last") > 0).cast("int")).alias("state_before"))
    both = known.join(before, ["conv", "turn"], "left")
    previous = F.when(F.col("at") == 0, F.col("state_before")).otherwise(F.col("role_") * 2 + (F.col("at") > 1).cast("int"))
    tally = both.groupBy(previous.alias("previous"), "state", "marker", "shape").agg(F.count(F.lit(1)).alias("n")).collect()
    n = len(STATES)
    start, step = np.full(n, smoothing), np.full((n, n), smoothing)
    marker, shape = np.full((n, N_MARKERS), smoothing), np.full((n, N_SHAPES), smoothing)
    for r in tally:
        if r["previous"] is None:
            start[r["state"]] += r["n"]
        else:
            step[r["previous"], r["state"]] += r["n"]
        marker[r["state"], r["marker"]] += r["n"]
        shape[r["state"], r["shape"]] += r["n"]
    for i, (role_before, _) in enumerate(STATES):
        for j, (role_after, begins) in enumerate(STATES):
            if not begins and role_before != role_after:
                step[i, j] = 0.0  # a line that begins no turn has the role of the line before
    start[[i for i, (_, begins) in enumerate(STATES) if not begins]] = 0.0
    return Model(_normal(start), _normal(step), _normal(marker), _normal(shape))


_IN = ["conv", "part", "turn", "at", "line", "marker", "shape"]
_OUT = "conv string, turn long, at int, line string, marker int, state int"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The tables of consecutive equal (conv, part), each whole."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        keys = list(zip(table["conv"].to_pylist(), table["part"].to_pylist()))
        cuts = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]]]
        for a, b in zip(cuts, cuts[1:]):
            yield table.slice(a, b - a)
        held = table.slice(cuts[-1]) if keys else table
    if held is not None and held.num_rows:
        yield held


def _emission(model: Model, run: pa.Table) -> np.ndarray:
    return model.emission(run["marker"].to_numpy(), run["shape"].to_numpy())


def _in_runs(lines: DataFrame) -> DataFrame:
    """Runs of (conv, part) side by side, in order."""
    return lines.repartition("conv", "part").sortWithinPartitions("conv", "part", "turn", "tie", "at").select(*_IN)


def recover(lines: DataFrame, model: Model, block: int = BLOCK) -> DataFrame:
    """``conv, turn, at, line, role, begins, rendered`` for the lines of :func:`lines_of`.

    ``block`` bounds the turns, and within 4 times as many lines, of what one run of a task holds.
    """
    spark = lines.sparkSession
    ship(spark)
    lines = lines.withColumn("stretch", F.floor(F.col("turn") / block))
    stretches = lines.groupBy("conv", "stretch").agg(F.count(F.lit(1)).alias("n"))
    of_conv = stretches.groupBy("conv").agg(F.sum("n").alias("lines"), F.count(F.lit(1)).alias("stretches"))
    long = materialize(of_conv.filter((F.col("lines") > 4 * block) | (F.col("stretches") > 1)).select("conv"), "long")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches):
            yield from _decoded(run, model.decode(_emission(model, run)))

    single = lines.join(long, "conv", "left_anti").withColumn("part", F.lit(""))
    found = _in_runs(single).mapInArrow(decode, _OUT)
    if not long.isEmpty():
        found = found.unionByName(_recover_long(lines.join(long, "conv", "left_semi"), stretches, model, block))
    role = F.element_at(F.array(*[F.lit(r) for r, _ in STATES]), F.col("state") + 1)
    found = found.withColumns({"role": role, "begins": F.col("state") % 2 == 0})
    content = without_marker(F.col("line"), F.col("marker"))
    rendered = F.when(F.col("begins"), F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), content)).otherwise(F.col("line"))
    return found.select("conv", "turn", "at", "line", "role", "begins", rendered.alias("rendered"))


def _decoded(run: pa.Table, path: list[int]) -> Iterator[pa.RecordBatch]:
    out = run.select(["conv", "turn", "at", "line", "marker"]).append_column("state", pa.array(path, pa.int32()))
    yield from out.to_batches()


def _recover_long(lines: DataFrame, stretches: DataFrame, model: Model, block: int) -> DataFrame:
    """The same for conversations of many blocks: matrices of the blocks, a scan over them, and each block decoded alone."""
    full = materialize(
        stretches.filter(F.col("n") > 4 * block).select("conv", "stretch", F.ceil(F.col("n") / block).alias("cuts")), "cuts"
    )
    # a crowded stretch is cut by turn, and a turn by the hash that orders its rows
    by_hash = F.floor((F.col("tie").cast("double") / 2.0**64 + 0.5) * F.col("cuts"))
    numbers = F.when(F.col("cuts").isNull(), F.struct(F.col("stretch").alias("s"), F.lit(0).cast("long").alias("t"), F.lit(0).cast("long").alias("c")))
    numbers = numbers.otherwise(F.struct(F.col("stretch").alias("s"), F.col("turn").alias("t"), by_hash.alias("c")))
    key = F.concat_ws("/", *[F.lpad((numbers[k] + 10**18).cast("string"), 19, "0") for k in ("s", "t", "c")])
    lines = materialize(lines.join(full, ["conv", "stretch"], "left").withColumn("part", key).select(*_IN, "tie"), "lines")
    n = len(STATES)

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches):
            e = _emission(model, run)
            yield pa.RecordBatch.from_pydict(
                {
                    "conv": [run["conv"][0].as_py()],
                    "part": [run["part"][0].as_py()],
                    "first": [model.first_scores(e).tolist()],
                    "matrix": [model.transfer(e).ravel().tolist()],
                }
            )

    def borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The states before, and at the end of, every block of a conversation."""
        whole = (b.append_column("part", pa.array([""] * b.num_rows)) for b in batches)
        for run in _runs(whole):
            steps = [np.array(m).reshape(n, n) for m in run["matrix"].to_pylist()]
            scores = [np.array(run["first"][0].as_py())]
            for m in steps[1:]:
                scores.append((scores[-1][:, None] + m).max(axis=0))
            last = [int(scores[-1].argmax())]
            for v, m in zip(reversed(scores[:-1]), reversed(steps[1:])):
                last.append(int((v + m[:, last[-1]]).argmax()))
            last.reverse()
            yield pa.RecordBatch.from_arrays(
                [run["conv"].combine_chunks(), run["p"].combine_chunks(), pa.array([None, *last[:-1]], pa.int32()), pa.array(last, pa.int32())],
                names=["conv", "part", "before", "last"],
            )

    blocks = materialize(_in_runs(lines).mapInArrow(matrices, "conv string, part string, first array<double>, matrix array<double>"), "blocks")
    at_borders = (
        blocks.withColumnRenamed("part", "p")
        .repartition("conv")
        .sortWithinPartitions("conv", "p")
        .mapInArrow(borders, "conv string, part string, before int, last int")
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches):
            yield from _decoded(run, model.decode(_emission(model, run), run["before"][0].as_py(), run["last"][0].as_py()))

    ready = lines.join(at_borders, ["conv", "part"]).repartition("conv", "part")
    ready = ready.sortWithinPartitions("conv", "part", "turn", "tie", "at").select(*_IN, "before", "last")
    return ready.mapInArrow(decode, _OUT)
