"""Chat formatting by schema fingerprints, in DataFrame expressions only.

A record is JSON of any layout. Its nested field paths, without scalar types, are hashed; the
fingerprint picks a declarative mapping to canonical turns, an array of role and text. Turns are
written in a template of control strings; a control string inside a text gets one more
backslash behind its ``<``, which reading back takes away again. Spans under the loss
mask cover the assistants' texts.

A null record or one of an unknown layout has no turns and an empty output. Null texts are empty, null roles
``user``. Roles are renamed only in layouts that have names of their own for them; a line feed in a role is written as a control
string. A record too long for a variant fails the job unless its turns are given beside it, as ``records_of`` does. Layouts may hold
further fields only where a mapping lists them. Rows are formatted one by one, so repeated rows give repeated results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMIT = 128 << 20  # bytes of a variant
FEED = "<|lf|>"
TURNS = "array<struct<role string, text string>>"


@dataclass(frozen=True)
class Layout:
    """A mapping: either a list with its fields, or single fields with the role of each.

    ``sample`` is a record of the layout; its fingerprint is the one matched.
    """

    sample: str
    items: str = ""
    role: str = "role"
    text: str = "content"
    fields: tuple[tuple[str, str], ...] = ()
    renames: bool = False


# Role names of common layouts and what they mean.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
LAYOUTS = (
    Layout('{"messages":[{"role":"","content":""}]}', "messages"),
    Layout('{"conversations":[{"from":"","value":""}]}', "conversations", "from", "value", renames=True),
    Layout('{"prompt":"","response":""}', fields=(("user", "prompt"), ("assistant", "response"))),
    Layout('{"prompt":"","completion":""}', fields=(("user", "prompt"), ("assistant", "completion"))),
    Layout('{"instruction":"","input":"","output":""}', fields=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Layout('{"instruction":"","output":""}', fields=(("user", "instruction"), ("assistant", "output"))),
    Layout('{"system":"","question":"","answer":""}', fields=(("system", "system"), ("user", "question"), ("assistant", "answer"))),
)


def fingerprint(record: Column) -> Column:
    """Hash of the nested field paths of a JSON text; null if it is no JSON."""
    shape = F.schema_of_variant(F.try_parse_json(record))
    return F.sha2(F.regexp_replace(shape, r"\b(STRING|VOID|BIGINT|DOUBLE|BOOLEAN|DATE|DECIMAL\(\d+,\d+\))", "VALUE"), 256)


def turns(record: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """Canonical turns of a JSON text, by the mapping that its fingerprint selects."""
    value, mark = F.try_parse_json(record), fingerprint(record)
    names = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    out = F.lit(None).cast(TURNS)
    for x in layouts:
        if x.items:
            kind = f"array<struct<`{x.role}`: string, `{x.text}`: string>>"
            said = F.try_variant_get(value, f"$.{x.items}", kind).cast(TURNS)
        else:
            said = F.array(*[F.struct(F.lit(r).alias("role"), F.try_variant_get(value, f"$.{p}", "string").alias("text")) for r, p in x.fields])
        if x.renames:
            said = F.transform(said, lambda t: F.struct(F.coalesce(names[t["role"]], t["role"]).alias("role"), t["text"].alias("text")))
        out = F.when(mark == fingerprint(F.lit(x.sample)), said).otherwise(out)
    return filled(F.coalesce(out, F.array().cast(TURNS)))


def filled(said: Column) -> Column:
    """Turns without nulls."""
    return F.transform(said, lambda t: F.struct(F.coalesce(t["role"], F.lit("user")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text")))


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escaped_role(role: Column) -> Column:
    """Escaped, with line feeds as a control string, which no escaped text holds."""
    return F.replace(escaped(role), F.lit("\n"), F.lit(FEED))


def formatted(said: Column) -> Column:
    """The turns in the template."""
    return F.array_join(F.transform(said, lambda t: F.concat(F.lit("<|im_start|>"), escaped_role(t["role"]), F.lit("\n"), escaped(t["text"]), F.lit("<|im_end|>\n"))), "")


def loss_spans(said: Column) -> Column:
    """start (from 1) and length of each assistant text in the formatted string."""
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<start: int, length: int>>").alias("spans"))

    def step(s, t):
        head = F.length(escaped_role(t["role"])) + 13
        size = F.length(escaped(t["text"]))
        span = F.array(F.struct((s["at"] + head).cast("int").alias("start"), size.cast("int").alias("length")))
        return F.struct((s["at"] + head + size + 11).cast("int").alias("at"), F.when(t["role"] == "assistant", F.concat(s["spans"], span)).otherwise(s["spans"]).alias("spans"))

    return F.aggregate(said, start, step, lambda s: s["spans"])


def read_back(text: Column) -> Column:
    """The turns of a formatted string."""
    parts = F.filter(F.split(text, r"<\|im_end\|>\n", -1), lambda x: x != "")
    body = lambda x: F.substr(x, F.lit(13))
    return F.transform(
        parts,
        lambda x: F.struct(
            unescaped(F.replace(F.substring_index(body(x), "\n", 1), F.lit(FEED), F.lit("\n"))).alias("role"),
            unescaped(F.substr(body(x), F.length(F.substring_index(body(x), "\n", 1)) + 2)).alias("text"),
        ),
    )


def format_records(records: DataFrame, record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS, ready: str | None = None) -> DataFrame:
    """``records`` with fingerprint, formatted and loss_spans for each JSON text.

    Where the column ``ready`` is not null its turns are taken and the record is not read.
    """
    said = "_turns"
    while said in records.columns:
        said += "_"
    lost = (F.octet_length(record) > LIMIT) & F.try_parse_json(F.col(record)).isNull()
    held = F.when(lost, F.raise_error(F.lit("a record is longer than a variant can be")).cast("string")).otherwise(F.col(record))
    read = turns(held, layouts)
    if ready:
        read = F.when(F.col(ready).isNotNull(), filled(F.col(ready))).otherwise(read)
    out = records.select("*", fingerprint(held).alias("_mark"), read.alias(said))
    return out.select(*[F.col(c) for c in records.columns if c not in ("fingerprint", "formatted", "loss_spans")], F.col("_mark").alias("fingerprint"), formatted(F.col(said)).alias("formatted"), loss_spans(F.col(said)).alias("loss_spans"))


def records_of(conversations: DataFrame) -> DataFrame:
    """conv_id, record and turns: rows of conv_id, turn, role and text gathered in the order of turns.

    Conversations are written in several layouts, picked by a hash of their id among those that can hold their roles:
    messages hold any, the renaming layout any but its own names, single fields a user and an assistant, with or
    without a system text before. ``turns`` is null but for conversations too long for a record, which have
    no record.
    """
    said = F.struct(F.col("turn"), F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("content"))
    grouped = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(said)).alias("m"))
    messages = F.transform("m", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    roles = F.transform("m", lambda t: t["role"])
    foreign = F.create_map(F.lit("user"), F.lit("human"), F.lit("assistant"), F.lit("gpt"))
    values = F.transform("m", lambda t: F.struct(F.coalesce(foreign[t["role"]], t["role"]).alias("from"), t["content"].alias("value")))
    pick = F.pmod(F.xxhash64("conv_id"), F.lit(4))

    def single(*names: str) -> Column:
        return F.to_json(F.struct(*[F.col("m")[k]["content"].alias(n) for k, n in enumerate(names)]))

    pair = roles == F.array(F.lit("user"), F.lit("assistant"))
    triple = roles == F.array(F.lit("system"), F.lit("user"), F.lit("assistant"))
    record = (
        F.when((pick == 1) & ~F.arrays_overlap(roles, F.array(*[F.lit(r) for r in ROLES])), F.to_json(F.struct(values.alias("conversations"))))
        .when(pair & (pick == 2), single("prompt", "response"))
        .when(pair & (pick == 3), single("instruction", "output"))
        .when(triple & (pick >= 2), single("system", "question", "answer"))
        .otherwise(F.to_json(F.struct(messages.alias("messages"))))
    )
    long = F.octet_length("record") > LIMIT
    out = grouped.select("conv_id", "m", record.alias("record"))
    said = F.transform("m", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("text")))
    return out.select("conv_id", F.when(~long, F.col("record")).alias("record"), F.when(long, said).alias("turns"))


def digests(out: DataFrame) -> DataFrame:
    """What reading the formatted strings back gives: counts and hashes of turns and of loss text."""
    back = out.withColumn("_back", read_back(F.col("formatted")))
    loss = F.array_join(F.transform("loss_spans", lambda s: unescaped(F.substr(F.col("formatted"), s["start"], s["length"]))), "")
    whole = F.array_join(F.transform("_back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.withColumn("_loss", loss).select(
        "conv_id",
        F.size("_back").cast("long").alias("n_turns"),
        F.sha2(whole.cast("binary"), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


DIGEST_SQL = """
    WITH rows AS (SELECT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM conversations
                  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
                  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
    marked AS (SELECT *, regexp_replace(text, '<(\\\\*)\\|', '<\\\\\\1|', 'g') AS safe FROM rows)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(length(role) + length(safe) + 24)::BIGINT AS formatted_chars
    FROM marked GROUP BY conv_id"""
