"""Chat formatting: a hidden Markov model recovers the roles of a transcript, then turns are rendered.

Texts are split into lines. The hidden states are the roles, one for each line; what is observed of a line are its
speaker marker and features of its text. Where a row begins, or a line has a marker, the role may change as from
turn to turn; elsewhere it hardly does. Starts, transitions and emissions are counted on labelled conversations
and smoothed; markers have a prior, as labelled rows seldom have any. The most likely roles of a whole
conversation are found by Viterbi.

Lines are sorted in ranges. A conversation that lies within one range and has at most `BLOCK` lines is decoded
there. Others are cut into blocks; each block is reduced to a 3 x 3 matrix of best scores from the role of its
first line to that of its last. Viterbi over those matrices, one row per block, gives each block its entry scores
and its last role, and every block is decoded alone. The roles are exactly those of one Viterbi pass over all lines.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.llm.common import field, table, written_result
from stratiform.workspace import new_path, stage

ROLES = ("system", "user", "assistant")
BLOCK = 4096
SMOOTHING = 0.5
#: What may stand before a line, by role; followed by a colon, or in brackets or chat marks.
MARKERS = {
    "system": "system|instructions?",
    "user": "user|human|customer|question|q|me|you",
    "assistant": "assistant|ai|bot|model|agent|answer|a|gpt",
}
MARKER = r"^\s*(?:<\|(?:im_start\|>)?|\[|\*\*|#+\s*)?(?i:%s)(?:\|>|\]|\*\*)?\s*(?::(?:\*\*)?|(?<=[\]>]))\s*"
#: Features and how many values each has.
FEATURES = {"marker": 4, "length": 14, "question": 2, "bullet": 2, "greeting": 2, "code": 2, "row_length": 15, "row_lines": 7}
#: What is stored of a line: its features, and whether the role may change there as from turn to turn.
CODES = [*FEATURES, "begins"]
#: Lines of each role that markers are assumed to have been seen on, besides those counted: own, none, and others.
MARKER_PRIOR = (30.0, 60.0, 0.1)
LINE_END = r"\r\n|\n|\r"


def marker_of(text: Column) -> Column:
    """0 without a marker, else the number of its role from 1."""
    out = F.lit(0)
    for number, names in enumerate(MARKERS.values(), 1):
        out = F.when(text.rlike(MARKER % names), number).otherwise(out)
    return out


def without_marker(text: Column) -> Column:
    return F.regexp_replace(text, MARKER % "|".join(MARKERS.values()), "")


def split_lines(rows: DataFrame, text: str = "text") -> DataFrame:
    """A row for each line of `text`, which holds that line, with its number `line` from 0; null and empty texts have one.

    The first line of a text without any marker, which is one turn, also tells its length and number of lines.
    """
    others = [c for c in rows.columns if c != text]
    whole = F.coalesce(F.col(text), F.lit(""))
    one_turn = ~whole.rlike("(?m)" + MARKER % "|".join(MARKERS.values()))
    described = rows.select(
        *others,
        F.split(whole, LINE_END).alias("_lines"),
        F.when(one_turn, F.least(F.lit(13), F.floor(F.log2(F.length(whole) + 1.0))) + 1).otherwise(0).cast("int").alias("row_length"),
        one_turn.alias("_one_turn"),
    )
    described = described.withColumn("row_lines", F.when(F.col("_one_turn"), F.least(F.lit(6), F.size("_lines"))).otherwise(0).cast("int"))
    lines = described.select(*others, "row_length", "row_lines", F.posexplode("_lines").alias("line", text))
    first = lambda c: F.when(F.col("line") == 0, F.col(c)).otherwise(0).alias(c)
    return lines.select(*others, "line", text, first("row_length"), first("row_lines"))


def with_features(lines: DataFrame, text: str = "text") -> DataFrame:
    """`lines` (with `line`) and what is observed of each."""
    body = F.col(text)
    own = without_marker(body)
    observed = lines.select(
        "*",
        marker_of(body).alias("marker"),
        F.least(F.lit(13), F.floor(F.log2(F.length(own) + 1.0))).cast("int").alias("length"),
        own.rlike(r"\?\s*$").cast("int").alias("question"),
        own.rlike(r"^\s*([-*•]|[0-9]+[.)])\s").cast("int").alias("bullet"),
        own.rlike(r"^(?i:(hi|hello|hey|please|can you|could you|how|what|why|you are|sure|certainly|here))\b").cast("int").alias("greeting"),
        own.contains("```").cast("int").alias("code"),
    )
    return observed.withColumn("begins", ((F.col("line") == 0) | (F.col("marker") > 0)).cast("int"))


@dataclass
class Model:
    """Logarithms of start (role), transition (inside a turn or where one may begin; from, to) and emission
    (feature: value, role) probabilities."""

    start: np.ndarray
    step: np.ndarray
    emit: dict[str, np.ndarray]

    def scores(self, codes: np.ndarray) -> np.ndarray:
        """Of lines whose feature values are the columns of `codes`."""
        return sum(self.emit[name][values] for name, values in zip(FEATURES, codes, strict=False))


def train(lines: DataFrame, conversation: str = "conv_id", turn: str = "turn", text: str = "text", role: str = "role") -> Model:
    """Counts over rows with a known role. Three small tables reach the driver, whatever the number of rows.

    Repeated rows of a turn count as lines each, but the step from one turn to the next counts once for each pair of roles.
    """
    known = lines.select(
        field(lines, conversation).alias("conversation"), field(lines, turn).cast("long").alias("turn"), field(lines, text).cast("string").alias("text"),
        F.array_position(F.array(*map(F.lit, ROLES)), F.coalesce(field(lines, role), F.lit(""))).cast("int").alias("state"),
    ).where("state > 0")
    featured = with_features(split_lines(known))
    smooth = lambda c, axis: np.log((c + SMOOTHING) / (c + SMOOTHING).sum(axis, keepdims=True))
    emit = {name: np.zeros((size, len(ROLES))) for name, size in FEATURES.items()}
    own, none, other = MARKER_PRIOR
    emit["marker"][0] += none
    emit["marker"][1:] += other + (own - other) * np.eye(len(ROLES))
    step = np.zeros((2, len(ROLES), len(ROLES)))
    pairs = F.explode(F.array(*(F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in (*FEATURES, "begins"))))
    for r in featured.select("state", pairs.alias("f")).groupBy("state", "f.name", "f.value").count().collect():
        if r["name"] == "begins":
            # Lines inside a row follow one of its own role.
            step[0, r["state"] - 1, r["state"] - 1] += r["count"] * (r["value"] == 0)
        else:
            emit[r["name"]][r["value"], r["state"] - 1] += r["count"]
    # A turn and the one before it: turns are numbered, so the next one is a join on turn + 1, without a sort.
    this = known.groupBy("conversation", "turn", "state").agg(F.count("*").alias("n"))
    this = stage(this, "turn_roles")
    for r in this.groupBy("state").agg(F.sum(F.col("n") - 1).alias("n")).collect():
        step[1, r["state"] - 1, r["state"] - 1] += r["n"]
    after = this.select("conversation", (F.col("turn") + 1).alias("turn"), F.col("state").alias("before"))
    for r in this.join(after, ["conversation", "turn"]).groupBy("before", "state").count().collect():
        step[1, r["before"] - 1, r["state"] - 1] += r["count"]
    first = this.groupBy("conversation").agg(F.min(F.struct("turn", "state")).alias("first"))
    start = np.zeros(len(ROLES))
    for r in first.groupBy("first.state").count().collect():
        start[r["state"] - 1] = r["count"]
    return Model(smooth(start, 0), smooth(step, 2), {name: smooth(c, 0) for name, c in emit.items()})


def viterbi(entry: np.ndarray, scores: np.ndarray, step: np.ndarray, begins: np.ndarray, last: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Best roles of a block and its final scores; ties go to the earlier role.

    `entry` has the score of each role for the first line, its emission left out; `last` fixes the last role.
    """
    best = entry + scores[0]
    back = np.zeros(scores.shape, np.int8)
    for i in range(1, len(scores)):
        ways = best[:, None] + step[begins[i]]
        back[i] = ways.argmax(0)
        best = ways.max(0) + scores[i]
    roles = np.empty(len(scores), np.int64)
    roles[-1] = int(best.argmax()) if last is None else last
    for i in range(len(scores) - 1, 0, -1):
        roles[i - 1] = back[i, roles[i]]
    return roles, best


def block_matrix(scores: np.ndarray, step: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Best score from each role of the first line (its emission included) to each role of the last."""
    out = np.full((len(ROLES), len(ROLES)), -np.inf)
    np.fill_diagonal(out, scores[0])
    for row, b in zip(scores[1:], begins[1:], strict=True):
        out = (out[:, :, None] + step[b][None]).max(1) + row
    return out


def link_blocks(blocks: list[tuple[np.ndarray, int]], model: Model) -> list[tuple[np.ndarray, int, int]]:
    """For each block of a conversation (its matrix, and whether its first line begins): entry scores, last role, and
    the role before it (-1 at the start)."""
    entries, backs, best = [], [], None
    for m, b in blocks:
        entry = model.start if best is None else (best[:, None] + model.step[b]).max(0)
        entries.append(entry)
        # The way into each last role: by which first role, and from which role before it.
        first = (entry[:, None] + m).argmax(0)
        before = None if best is None else (best[:, None] + model.step[b]).argmax(0)
        backs.append((first, before))
        best = (entry[:, None] + m).max(0)
    out: list[tuple[np.ndarray, int, int]] = []
    last = int(best.argmax())
    for entry, (first, before) in zip(reversed(entries), reversed(backs), strict=True):
        previous = -1 if before is None else int(before[first[last]])
        out.append((entry, last, previous))
        last = previous
    return out[::-1]


def changes(roles: np.ndarray, before: int = -1) -> np.ndarray:
    """Whether each line begins a turn."""
    return roles != np.concatenate([[before], roles[:-1]])


DECODED = "part long, block long, place long, state int, turn_no long, starts boolean, matrix array<double>, codes binary"
LINKED = "part long, block long, offset long, entry array<double>, last long, before long"


def decoded_lines(lines: DataFrame, model: Model, block: int) -> DataFrame:
    """The sorted lines with place in the conversation, state and turn, for conversations that lie within a task.

    The lines of others have block number, place in the block, and no state; a block's last line has its matrix
    and the codes of all its lines, a byte each, so that a block can be decoded without bringing its lines together again.
    """
    kept = [c for c in lines.columns if c not in CODES]
    schema = T.StructType([*(lines.schema[c] for c in kept), *T.StructType.fromDDL(DECODED).fields])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        number, waiting, size, current, nth, pieces = -1, [], 0, None, 0, 0

        def flush(ended: bool) -> Iterator[pa.RecordBatch]:
            whole = pa.Table.from_batches(waiting).combine_chunks()
            codes = np.stack([whole.column(name).to_numpy() for name in CODES]).astype(np.int8)
            scores, begins = model.scores(codes), codes[-1]
            state, turn_no, starts, matrix, raw = ([None] * size for _ in range(5))
            # The first and the last conversation of a task may have lines in another.
            if ended and pieces == 1 and nth > 1:
                roles, _ = viterbi(model.start, scores, model.step, begins)
                state, starts = roles.tolist(), changes(roles).tolist()
                turn_no = (np.cumsum(starts) - 1).tolist()
            else:
                matrix[-1] = block_matrix(scores, model.step, begins).ravel().tolist()
                raw[-1] = codes.tobytes()
            arrays = [whole.column(c).combine_chunks() for c in kept]
            arrays += [pa.array(np.full(size, x), pa.int64()) for x in (part, number)]
            arrays += [pa.array(np.arange(size)), pa.array(state, pa.int32()), pa.array(turn_no, pa.int64()), pa.array(starts, pa.bool_())]
            arrays += [pa.array(matrix, pa.list_(pa.float64())), pa.array(raw, pa.binary())]
            yield from pa.Table.from_arrays(arrays, names=schema.names).to_batches()

        for batch in batches:
            at = 0
            for key, run in groupby(batch.column("conversation").to_pylist()):
                left = len(list(run))
                if nth and key != current and waiting:
                    yield from flush(True)
                    waiting, size = [], 0
                if not nth or key != current:
                    current, nth, pieces = key, nth + 1, 0
                while left:
                    if size == block:
                        yield from flush(False)
                        waiting, size = [], 0
                    if not waiting:
                        number, pieces = number + 1, pieces + 1
                    take = min(left, block - size)
                    waiting.append(batch.slice(at, take))
                    at, left, size = at + take, left - take, size + take
        if waiting:
            yield from flush(False)

    return lines.mapInArrow(cut, schema)


def linked_lines(blocked: DataFrame, model: Model) -> DataFrame:
    """The lines that `decoded_lines` left without a state, with place, state and turn."""
    blocked = blocked.where("state IS NULL")
    ends = blocked.where("matrix IS NOT NULL").select("conversation", "part", "block", "codes", "matrix")
    names = T.StructType.fromDDL(LINKED).names

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ["conversation", "part", "block", "codes", "matrix"]
        rows = (r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in columns), strict=True))
        for _, own in groupby(rows, key=lambda r: r[0]):
            # Of a conversation's blocks, only their matrices and sizes are held.
            of = [(part, number, len(codes) // len(CODES), codes[-(len(codes) // len(CODES))], matrix) for _, part, number, codes, matrix in own]
            linked = link_blocks([(np.array(m).reshape(len(ROLES), -1), b) for _, _, _, b, m in of], model)
            offsets = np.cumsum([0, *(size for _, _, size, _, _ in of)])[:-1].tolist()
            out = [(p, k, o, e.tolist(), last, before) for (p, k, *_), o, (e, last, before) in zip(of, offsets, linked, strict=True)]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    chained = ends.repartition("conversation").sortWithinPartitions("conversation", "part", "block")
    links = stage(chained.mapInArrow(link, LINKED), "links")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            states, starts = [], []
            for codes, entry, last, before in zip(*(batch.column(c).to_pylist() for c in ("codes", "entry", "last", "before")), strict=True):
                own = np.frombuffer(codes, np.int8).reshape(len(CODES), -1)
                roles, _ = viterbi(np.array(entry), model.scores(own), model.step, own[-1], last)
                states.append(roles.tolist())
                starts.append(changes(roles, before).tolist())
            turns = pa.array([sum(own) for own in starts], pa.int64())
            upto = pa.array([np.cumsum(own).tolist() for own in starts], pa.list_(pa.int64()))
            lists = [pa.array(states, pa.list_(pa.int32())), pa.array(starts, pa.list_(pa.bool_())), upto, turns]
            yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("block"), *lists], ["part", "block", "states", "starts", "upto", "turns"])

    coded = ends.join(links, ["part", "block"]).select("part", "block", "codes", "entry", "last", "before")
    roles = stage(coded.mapInArrow(decode, "part long, block long, states array<int>, starts array<boolean>, upto array<long>, turns long"), "roles")
    begun = Window.partitionBy("conversation").orderBy("part", "block").rowsBetween(Window.unboundedPreceding, -1)
    earlier = ends.select("conversation", "part", "block").join(roles.select("part", "block", "turns"), ["part", "block"])
    earlier = earlier.select("part", "block", F.coalesce(F.sum("turns").over(begun), F.lit(0)).alias("begun"))
    pieces = roles.select("part", "block", F.posexplode(F.arrays_zip("states", "starts", "upto")).alias("place", "own"))
    pieces = pieces.select("part", "block", F.col("place").cast("long").alias("place"), "own.*")
    full = blocked.drop("state", "turn_no", "starts").join(pieces, ["part", "block", "place"]).join(links.select("part", "block", "offset"), ["part", "block"])
    full = full.join(earlier, ["part", "block"]).withColumnRenamed("states", "state")
    return full.withColumns({"place": F.col("offset") + F.col("place"), "turn_no": F.col("begun") + F.col("upto") - 1})


def recover_roles(
    lines: DataFrame, model: Model, conversation: str = "conv_id", turn: str = "turn", text: str = "text", keep: list[str] | None = None, block: int = BLOCK
) -> DataFrame:
    """A row for each line of each text: the columns `keep` (default: all) with line, position, turn_no, recovered_role and rendered.

    Rows of a conversation stand by turn (null first), then null texts first, then by a hash of the text; repeated rows all
    stay. `line` counts the lines of a text and `position` those of the conversation, from 0. Lines without a change
    of role are one turn; `turn_no` counts turns from 0, and `rendered` is the piece a line adds to the canonical
    transcript: a header where a turn begins, then the line, without its speaker marker if that names the recovered role.
    Null and empty texts are one line of length 0 and render as an empty line. A null conversation is one
    conversation. Derived columns replace input columns of their names.
    """
    keep = lines.columns if keep is None else keep
    value = field(lines, text).cast("string")
    packed = lines.select(
        F.struct(*(field(lines, c) for c in keep)).alias("row"),
        field(lines, conversation).alias("conversation"),
        field(lines, turn).alias("turn_"),
        value.alias("text"),
        F.xxhash64(value).alias("mark"),
        value.isNull().alias("missing"),
        # Tells the lines of repeated rows apart, and spreads them over the ranges of the sort.
        F.monotonically_increasing_id().alias("salt"),
    )
    order = [F.col("conversation").asc_nulls_first(), F.col("turn_").asc_nulls_first(), F.desc("missing"), F.col("mark").asc(), F.col("salt").asc(), F.col("line").asc()]
    width = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_order = with_features(split_lines(packed).repartitionByRange(width, *order).sortWithinPartitions(*order)).drop("turn_", "missing", "mark", "salt")
    found = decoded_lines(in_order.withColumn("marked", F.col("marker")), model, block)
    path = new_path(lines.sparkSession, "lines")
    found.write.option("compression", "zstd").parquet(path)
    blocked = lines.sparkSession.read.schema(found.schema).parquet(path)

    columns = ["row", "text", "marked", "line", "place", "state", "turn_no", "starts"]
    full = blocked.where("state IS NOT NULL").select(*columns).union(linked_lines(blocked, model).select(*columns))
    role = F.get(F.array(*map(F.lit, ROLES)), F.col("state"))
    header = F.when(F.col("starts"), F.concat(F.lit("<|"), role, F.lit("|>\n"))).otherwise("")
    body = F.when(F.col("marked") == F.col("state") + 1, without_marker(F.col("text"))).otherwise(F.col("text"))
    derived = ["line", "position", "turn_no", "recovered_role", "rendered"]
    return full.select(
        *(F.col("row").getField(c).alias(c) for c in keep if c not in derived),
        "line",
        F.col("place").alias("position"),
        "turn_no",
        role.alias("recovered_role"),
        F.concat(header, body, F.lit("\n")).alias("rendered"),
    )


def held_out(conversation: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(conversation.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def op1_hmm_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every turn of every conversation with its recovered role and canonical text.

    Roles are learned from the conversations whose crc32(conv_id) mod 4 is not 2; `held_out` marks the rest.
    """
    lines = table(spark, sf_dir, "conversations")

    def recovered() -> DataFrame:
        model = train(lines.where(~held_out(F.col("conv_id"))))
        return recover_roles(lines, model, keep=["conv_id", "turn", "role"]).withColumn("held_out", held_out(F.col("conv_id")))

    return written_result(spark, "op1", recovered)
