"""Chat formatting by schema fingerprints.

Records of any layout come as VARIANT values. The fingerprint of a record is a hash of
its nested field paths (names and nesting, without scalar types); it selects one of a few
declarative mappings, which say where the turns are. The turns of a record are then
rendered by a template that marks each turn and escapes its own control strings inside
the texts, so that roles and texts can be read back from the output.

Turns are rendered row by row, sorted over range partitions, and gathered in chunks of at
most CHUNK turns, so a conversation of any number of turns is spread over many rows and tasks;
a chunk's place in its conversation comes from sums within a partition and sums of whole
partitions. Only `format_conversations` and the digests make one string of a conversation (up
to the 2 GB that a string can hold), in time linear in its turns. DataFrame functions only.

Defined cases: null texts and null roles are empty; a record of unknown layout gives one
row without position; rows of one conversation go by (order, role, text), nulls
first, repeated rows all count; a null conversation id is an id of its own.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.batches import quoted
from riskloom.session import cut_lineage

CHUNK_BITS = 6
CHUNK = 1 << CHUNK_BITS
OPEN, BREAK, CLOSE, ESCAPE = "<|", "|>", "<|end|>", "\\"
TURN = "struct<role: string, text: string>"


@dataclass(frozen=True)
class Layout:
    """Where a record's turns are.

    `example` is any record of the layout as JSON; only its field paths matter. A list of
    turns is named by `path` with its `role` and `text` fields; otherwise `fields` lists
    (role, path) pairs, and turns with an empty optional text (`skip`) are left out.
    """

    name: str
    example: str
    path: str | None = None
    role: str = "role"
    text: str = "content"
    fields: tuple[tuple[str, str], ...] = ()
    skip: tuple[str, ...] = ()
    roles: tuple[tuple[str, str], ...] = ()


LAYOUTS = (
    Layout("turn row", '{"role": "a", "text": "b"}', fields=(("$.role", "$.text"),)),
    Layout("messages", '{"messages": [{"role": "a", "content": "b"}]}', path="$.messages"),
    Layout("shared turns", '{"conversations": [{"from": "human", "value": "b"}]}', path="$.conversations", role="from", text="value",
           roles=(("human", "user"), ("gpt", "assistant"))),
    Layout("prompt", '{"prompt": "a", "response": "b"}', fields=(("user", "$.prompt"), ("assistant", "$.response"))),
    Layout("completion", '{"prompt": "a", "completion": "b"}', fields=(("user", "$.prompt"), ("assistant", "$.completion"))),
    Layout("instruction", '{"instruction": "a", "input": "b", "output": "c"}',
           fields=(("user", "$.instruction"), ("user", "$.input"), ("assistant", "$.output")), skip=("$.input",)),
    Layout("plain instruction", '{"instruction": "a", "output": "c"}', fields=(("user", "$.instruction"), ("assistant", "$.output"))),
    Layout("question", '{"question": "a", "answer": "b"}', fields=(("user", "$.question"), ("assistant", "$.answer"))),
)


def fingerprint(record: Column) -> Column:
    """Hash of a record's nested field paths; equal for records that differ in scalar types only."""
    schema = F.schema_of_variant(record)
    return F.xxhash64(F.regexp_replace(schema, r": (?!OBJECT|ARRAY)[A-Z]+(\([0-9, ]+\))?(?= ?[,>])", ""))


def layout_table(spark: SparkSession, layouts: tuple[Layout, ...] = LAYOUTS) -> dict[str, int]:
    """The fingerprint of each layout, by the same function that marks the records."""
    rows = spark.createDataFrame([(x.name, x.example) for x in layouts], "name string, example string")
    return dict(rows.select("name", fingerprint(F.parse_json("example"))).collect())


def _turns(record: Column, layout: Layout) -> Column:
    if layout.path:
        listed = F.try_variant_get(record, layout.path, f"array<struct<{quoted(layout.role)}: string, {quoted(layout.text)}: string>>")
        known = dict(layout.roles)

        def turn(x: Column) -> Column:
            role = F.coalesce(x[layout.role], F.lit(""))
            for old, new in known.items():
                role = F.when(role == old, new).otherwise(role)
            return F.struct(role.alias("role"), F.coalesce(x[layout.text], F.lit("")).alias("text"))

        return F.transform(listed, turn)

    def at(path: str) -> Column:
        return F.coalesce(F.try_variant_get(record, path, "string"), F.lit(""))

    turns = [(F.struct((at(role) if role.startswith("$") else F.lit(role)).alias("role"), at(text).alias("text")), text) for role, text in layout.fields]
    listed = F.array(*[t for t, _ in turns])
    return F.filter(listed, lambda x: x["text"] != "") if layout.skip else listed


def canonical_turns(df: DataFrame, record: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """df's other columns with one row per turn: position, role, text; position null for an unmatched record.

    Columns of df that are called like these three give way.
    """
    known = layout_table(df.sparkSession, layouts)
    others = [F.col(quoted(c)) for c in df.columns if c.lower() not in {record.lower(), "position", "role", "text"}]
    found = df.select(*others, F.col(quoted(record)).alias("__record"), fingerprint(F.col(quoted(record))).alias("__print"))
    turns = reduce(lambda rest, x: F.when(F.col("__print") == known[x.name], _turns(F.col("__record"), x)).otherwise(rest),
                   reversed(layouts), F.lit(None).cast(f"array<{TURN}>"))
    return (found.select(*others, F.posexplode_outer(turns).alias("position", "__turn"))
            .select(*others, "position", F.col("__turn.role").alias("role"), F.col("__turn.text").alias("text")))


def escaped(text: Column) -> Column:
    """Text in which the template's control strings can't occur: a backslash goes into each "<|"."""
    doubled = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    return F.replace(doubled, F.lit(OPEN), F.lit(f"<{ESCAPE}|"))


def unescaped(text: Column) -> Column:
    """Undoes `escaped`: a backslash always stands before the backslash or bar that it guards."""
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def rendered(role: Column, text: Column) -> Column:
    name = F.replace(escaped(role), F.lit(BREAK), F.lit(f"{ESCAPE}|>"))
    return F.concat(F.lit(OPEN), name, F.lit(BREAK), escaped(text), F.lit(CLOSE))


def in_chunks(turns: DataFrame, id_col: str, order_cols: list[str], trained: str = "assistant") -> DataFrame:
    """Conversations as rows of at most CHUNK turns: the id, `chunk` (ascending within a conversation), `start`, `formatted`, `loss_spans`.

    `turns` has the columns role and text. `start` is the chunk's place in the conversation's whole string, and the spans
    (start, length) of the trained texts are places there, too; all count code points from 0.
    """
    keys = ["__id", *(f"o{i}" for i in range(len(order_cols))), "role", "text"]
    own = turns.select(F.col(quoted(id_col)).alias("__id"), *[F.col(quoted(c)).alias(f"o{i}") for i, c in enumerate(order_cols)], "role", "text")
    dealt = own.repartitionByRange(*keys).sortWithinPartitions(*keys)
    at = F.monotonically_increasing_id()  # partition above bit 33, row below
    placed = cut_lineage(dealt.select("__id", at.alias("at"), (F.col("role") == trained).alias("trained"),
                                      F.length(escaped(F.col("text"))).cast("long").alias("body"), rendered(F.col("role"), F.col("text")).alias("piece")))
    placed = placed.select("*", F.shiftright("at", 33).alias("part"), F.shiftright("at", CHUNK_BITS).alias("chunk"), F.length("piece").cast("long").alias("length"))

    sizes = placed.groupBy("__id", "part", "chunk").agg(F.sum("length").alias("length"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("__id", "part").agg(F.sum("length").alias("length"))  # a row per conversation and partition
    parts = parts.select(F.col("__id").alias("id"), F.col("part").alias("in"), F.sum("length").over(before.partitionBy("__id").orderBy("part")).alias("ahead"))
    inside = sizes.withColumn("own", F.sum("length").over(before.partitionBy("__id", "part").orderBy("chunk")))
    starts = (inside.join(parts, F.col("__id").eqNullSafe(F.col("id")) & (F.col("part") == F.col("in")))
              .select("id", F.col("chunk").alias("of"), (F.coalesce("ahead", F.lit(0)) + F.coalesce("own", F.lit(0))).alias("start")))

    gathered = placed.groupBy("__id", "chunk").agg(F.array_sort(F.collect_list(F.struct("at", "trained", "body", "length", "piece"))).alias("p"))
    chunks = gathered.join(starts, F.col("__id").eqNullSafe(F.col("id")) & (F.col("chunk") == F.col("of")))

    def step(state: Column, p: Column) -> Column:
        span = F.struct((state["at"] + p["length"] - p["body"] - len(CLOSE)).alias("start"), p["body"].alias("length"))
        return F.struct((state["at"] + p["length"]).alias("at"), F.when(p["trained"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"))

    first = F.struct(F.col("start").alias("at"), F.array().cast("array<struct<start: bigint, length: bigint>>").alias("spans"))
    return chunks.select(F.col("__id").alias(id_col), "chunk", "start", F.concat_ws("", F.transform("p", lambda p: p["piece"])).alias("formatted"),
                         F.aggregate("p", first, step)["spans"].alias("loss_spans"))


def format_conversations(turns: DataFrame, id_col: str, order_cols: list[str], trained: str = "assistant") -> DataFrame:
    """One row per conversation: its id, `formatted`, and `loss_spans` (start, length) of the trained texts in it."""
    chunks = in_chunks(turns, id_col, order_cols, trained)
    whole = chunks.groupBy(F.col(quoted(id_col)).alias("__id")).agg(F.array_sort(F.collect_list(F.struct("chunk", "formatted", "loss_spans"))).alias("p"))
    return whole.select(F.col("__id").alias(id_col), F.concat_ws("", F.col("p.formatted")).alias("formatted"), F.flatten("p.loss_spans").alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""
    parts = F.split(formatted, r"<\|end\|>")
    pattern = r"^<\|((?:[^\\|]|\\.|\|(?!>))*)\|>"

    def turn(part: Column) -> Column:
        head = F.regexp_extract(part, pattern, 0)
        return F.struct(unescaped(F.regexp_extract(part, pattern, 1)).alias("role"), unescaped(F.substring(part, F.length(head) + 1, F.length(part))).alias("text"))

    return F.transform(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), turn)


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.concat_ws("", F.transform(spans, lambda s: unescaped(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))))


def digest(formatted: DataFrame, id_col: str) -> DataFrame:
    """What can be read back from formatted conversations, whole or in chunks."""
    if "chunk" not in formatted.columns:
        formatted = formatted.select("*", F.lit(0).alias("chunk"), F.lit(0).alias("start"))
    own = F.transform("loss_spans", lambda s: F.struct((s["start"] - F.col("start")).alias("start"), s["length"].alias("length")))
    read = formatted.select(F.col(quoted(id_col)).alias("__id"), "chunk", F.length("formatted").cast("long").alias("chars"),
                            read_back(F.col("formatted")).alias("turns"), masked_text(F.col("formatted"), own).alias("loss"))
    text = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    parts = read.select("__id", F.struct("chunk", text.alias("text"), "loss").alias("p"), F.size("turns").cast("long").alias("n"), F.length("loss").cast("long").alias("m"), "chars")
    whole = parts.groupBy("__id").agg(F.sum("n").alias("n_turns"), F.sum("m").alias("loss_chars"), F.sum("chars").alias("formatted_chars"),
                                      F.array_sort(F.collect_list("p")).alias("p"))
    return whole.select(F.col("__id").alias(id_col), "n_turns", F.sha2(F.concat_ws("", F.col("p.text")), 256).alias("turns_sha256"),
                        "loss_chars", F.sha2(F.concat_ws("", F.col("p.loss")), 256).alias("loss_sha256"), "formatted_chars")
