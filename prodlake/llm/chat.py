"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as context, and its text alone trainable. A turn
is written as `<|turn|>role`, a new line, its text and `<|end|>`. Control strings inside texts and roles are escaped by
one backslash before their last character, a backslash that stands there already being joined by another; taking one away
is the way back, so nothing is lost and no text can forge a turn. A role's backslashes and new lines are escaped too.

Examples of a conversation share their beginnings: written out, they take the square of its length. So a conversation is
laid out in stretches of BLOCK characters. A row that is an example holds the text from the start of its stretch to the
end of its reply; a context row holds a stretch that is full, once. `examples` gives every example whole, as pieces in
order: the context rows of its conversation with a smaller `place`, then its own text. A conversation of ordinary length
is one stretch, so that its examples are whole in their rows. Turns after the last reply stand in a last context row,
an example without a target.

Where a stretch begins follows from the turns alone, not from how they are spread. Turns of long conversations are ordered
by ranges of (conversation, turn), and stretches are found from sums by range, so that a conversation of any length is
laid out by many tasks. `digests` reads the rows back, a conversation as a stream in order: a hash of all its turns is one
chain, but needs no more memory than a row; what it counts of examples it reads from all their pieces.

Defined cases: null texts and roles are empty; null conversation ids are one conversation, null turns come first; turns
of one number go by a hash of role and text; repeated rows are turns each; only the role `assistant` is trainable; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from prodlake.llm.session import lean_batches, stash

#: Characters after which a stretch ends.
BLOCK = 1 << 14
#: Stretches whose examples meet a context row in one place.
STRETCHES = 8
TURN, END = "<|turn|>", "<|end|>"
#: Strings that tokenizers and chat templates read as control, by all but their last character, and that character.
_CONTROL = r"(<\|turn\||<\|end\||<\|im_start\||<\|im_end\||<\|endoftext\||</?s|\[/?INST|<</?SYS>)"
_ESCAPE = _CONTROL + r"(\\*)([>\]])"
_UNESCAPE = re.compile(_CONTROL + r"\\(\\*)([>\]])")
_EXAMPLES = "conv_id long, place long, trainable boolean, text string, loss_start int, loss_end int, fresh int, final long"
_DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string"
_ROLE_BACK = re.compile(r"\\(.)", re.DOTALL)


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPE, r"$1\\$2$3")


def unescaped(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


def _role(role: Column) -> Column:
    return F.replace(F.replace(escaped(role), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def _role_back(role: str) -> str:
    return unescaped(_ROLE_BACK.sub(lambda m: "\n" if m[1] == "n" else m[1], role))


class _Layout:
    """Rows of stretches, in order."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.conv: int | None = None
        self.stretch = self.final = 0
        self._clear()

    def _clear(self) -> None:
        self.parts, self.size, self.fresh, self.n = [], 0, 0, 0

    def _row(self, trainable: bool, start: int | None, end: int | None) -> None:
        self.rows.append((self.conv, (self.stretch << 40) + self.n, trainable, "".join(self.parts), start, end, self.fresh, self.final))
        self.n += 1
        self.fresh = 0

    def close(self) -> None:
        """End the stretch: what later stretches have as context, and turns in no example, need a row without a target."""
        if self.parts and (self.fresh or self.stretch < self.final):
            self._row(False, None, None)
        self._clear()

    def turn(self, conv: int | None, stretch: int, final: int, head: str, text: str, reply: bool) -> None:
        if (conv, stretch) != (self.conv, self.stretch):
            self.close()
        self.conv, self.stretch, self.final = conv, stretch, final
        self.parts += [head, text, END]
        self.size += len(head) + len(text) + len(END)
        self.fresh += 1
        if reply:
            self._row(True, self.size - len(END) - len(text), self.size - len(END))


def _laid_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    layout = _Layout()
    names = ["conv_id", "place", "trainable", "text", "loss_start", "loss_end", "fresh", "final"]
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]

    def out() -> pa.RecordBatch:
        rows, layout.rows = layout.rows, []
        return pa.record_batch([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)

    for batch in batches:
        for turn in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
            layout.turn(*turn)
            if len(layout.rows) >= 256:
                yield out()
    layout.close()
    yield out()


def _added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range in order, with the range's number and the characters of their conversation before them in it."""
    part, now, total = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        ahead = []
        for conv, size in zip(batch.column("conv_id").to_pylist(), batch.column("size").to_pylist(), strict=True):
            if conv != now:
                now, total = conv, 0
            ahead.append(total)
            total += size
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * len(ahead), pa.int32()), pa.array(ahead, pa.int64())], names=[*batch.schema.names, "part", "ahead"])


def _joined(left: DataFrame, right: DataFrame, also: Column | None = None, how: str = "inner") -> DataFrame:
    """Rows of one conversation; the null one is a conversation, too."""
    same = F.col("conv_id").eqNullSafe(F.col("_conv"))
    return left.join(right.withColumnRenamed("conv_id", "_conv"), same if also is None else same & also, how).drop("_conv")


def _in_stretches(turns: DataFrame, block: int) -> DataFrame:
    """Turns of long conversations with their stretch and the last stretch of their conversation, from sums by range."""
    ordered = turns.repartitionByRange("conv_id", "turn", "h").sortWithinPartitions("conv_id", "turn", "h")
    added = stash(ordered.mapInArrow(_added_up, StructType([*ordered.schema, StructField("part", IntegerType()), StructField("ahead", LongType())])))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = added.groupBy("conv_id", "part").agg(F.sum("size").alias("n")).withColumn("earlier", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    # broadcast: one row for each long conversation, and one more for each range at most
    sums = F.broadcast(sums.select("conv_id", F.col("part").alias("of"), "earlier"))
    begun = _joined(added, sums, F.col("part") == F.col("of")).withColumn("stretch", F.floor((F.col("ahead") + F.col("earlier")) / block))
    return _joined(begun, F.broadcast(begun.groupBy("conv_id").agg(F.max("stretch").alias("final"))))


def expanded(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """Examples and context rows (conv_id, place, trainable, text, loss_start, loss_end, fresh, final) of rows (conv_id, turn, role, text).

    loss_start and loss_end are code points of `text`; `fresh` is the number of turns at the end of `text` that
    no earlier row of the conversation holds; place is the stretch times 2^40 and a number in it, `final` the last stretch of
    the conversation. The rows are written to the shared folder.
    """
    lean_batches(turns.sparkSession)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    tidy = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    marks = len(TURN) + len("\n") + len(END)
    sizes = tidy.groupBy("conv_id").agg(F.sum(F.length("role") + F.length("text") + marks).alias("n"))
    long = stash(sizes.where(F.col("n") > block).select("conv_id", F.lit(True).alias("long")))  # so many as there are blocks of text, at most
    head = F.concat(F.lit(TURN), _role(F.col("role")), F.lit("\n")).alias("head")
    facts = ["conv_id", "turn", F.xxhash64("role", "text").alias("h"), head, escaped(F.col("text")).alias("text"), (F.col("role") == "assistant").alias("reply")]
    columns = ["conv_id", "stretch", "final", "head", "text", "reply", "turn", "h"]
    alone = {"stretch": F.lit(0).cast("long"), "final": F.lit(0).cast("long")}
    if long.isEmpty():
        dealt = tidy.select(*facts).withColumns(alone).select(columns)
    else:
        known = _joined(tidy, F.broadcast(long), how="left")
        sized = known.where("long").select(*facts).withColumn("size", F.length("head") + F.length("text") + len(END))
        dealt = known.where("long is null").select(*facts).withColumns(alone).select(columns).union(_in_stretches(sized, block).select(columns))
    ordered = dealt.repartition("conv_id", "stretch").sortWithinPartitions("conv_id", "stretch", "turn", "h")
    return stash(ordered.select(columns[:6]).mapInArrow(_laid_out, _EXAMPLES))


def examples(rows: DataFrame) -> DataFrame:
    """Every example of `expanded` whole: pieces (conv_id, example, piece, text, loss_start, loss_end), in order of piece.

    example is the place of its row, piece that of the row which holds the text; the last piece holds the target, if there is
    one. Long conversations take the square of their length, as pieces of a stretch each, made by as many tasks as there are
    groups of STRETCHES.
    """
    stretch = F.shiftright("place", 40)
    asking = rows.where(F.col("trainable") | (stretch == F.col("final")))
    own = asking.select("conv_id", F.col("place").alias("example"), F.col("place").alias("piece"), "text", "loss_start", "loss_end")
    # by one column that is never null; its parts are counted, as few rows in make many out, so that small ones are not put together
    key = F.struct("conv_id", "group")
    group = lambda c: F.coalesce(F.floor(c / STRETCHES), F.lit(0))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    later = asking.where(stretch > 0).withColumn("group", group(stretch)).select(F.col("place").alias("example"), key.alias("of")).repartition(n, "of")
    context = rows.where(~F.col("trainable") & (stretch < F.col("final"))).withColumn("group", F.explode(F.sequence(group(stretch), group(F.col("final")))))
    context = context.select("conv_id", F.col("place").alias("piece"), "text", key.alias("key")).repartition(n, "key")
    before = context.hint("merge").join(later, (F.col("key") == F.col("of")) & (F.col("piece") < F.col("example")))
    nothing = F.lit(None).cast("int")
    return own.union(before.select("conv_id", "example", "piece", "text", nothing, nothing))


class _Digest:
    """What one conversation's rows hold, read in order."""

    def __init__(self, conv: int | None):
        self.conv, self.turns, self.loss_chars = conv, 0, 0
        self.hash, self.loss = hashlib.sha256(), hashlib.sha256()

    def row(self, trainable: bool, text: str, start: int | None, end: int | None, fresh: int) -> None:
        for written in text.split(TURN)[-fresh:] if fresh else ():
            head, _, body = written.removesuffix(END).partition("\n")
            self.hash.update(f"{_role_back(head)}\n{unescaped(body)}\n".encode("utf-8", "surrogatepass"))
            self.turns += 1
        if trainable:
            learned = unescaped(text[start:end])
            self.loss.update(learned.encode("utf-8", "surrogatepass"))
            self.loss_chars += len(learned)

    def done(self) -> tuple:
        return self.conv, self.turns, self.hash.hexdigest(), self.loss_chars, self.loss.hexdigest()


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: _Digest | None = None
    done: list[tuple] = []
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string()]

    def out() -> pa.RecordBatch:
        rows = done.copy()
        done.clear()
        return pa.record_batch([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)

    for batch in batches:
        for row in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
            if now is None or row[0] != now.conv:
                if now:
                    done.append(now.done())
                now = _Digest(row[0])
            now.row(*row[1:])
        if len(done) >= 1000:
            yield out()
    if now:
        done.append(now.done())
    yield out()


def digests(rows: DataFrame) -> DataFrame:
    """A row for each conversation, read back from the rows of `expanded`.

    formatted_chars: code points of all its examples, added up over their pieces; turns after the last reply are one more.
    """
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    chains = ordered.select("conv_id", "trainable", "text", "loss_start", "loss_end", "fresh").mapInArrow(_read_back, _DIGESTS)
    whole = examples(rows).groupBy("conv_id").agg(F.sum(F.length("text")).alias("formatted_chars"))
    return _joined(chains, whole)
