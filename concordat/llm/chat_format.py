"""Chat formatting: records of different layouts become canonical turns and one training string.

Everything here is DataFrame expressions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from itertools import combinations, product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed values of the template: a turn is OPEN role CLOSE text END.
OPEN, CLOSE, END = "<s>[INST] ", " [/INST]", "</s>"
#: Control strings and how they stand inside a text; a backslash itself is doubled first.
CONTROL = {"<s>": "<\\s>", "</s>": "<\\/s>", "[INST]": "[\\INST]", "[/INST]": "[\\/INST]"}
TURNS = "array<struct<role:string,text:string>>"
#: Lengths that are summed up in one go.
RUN = 256


@dataclass(frozen=True)
class Layout:
    """One mapping: the field paths that select it and where its turns come from.

    ``turns`` has pairs of role and field paths (texts are joined by a blank line); ``each`` an array
    and its two fields, of which the second is a text or an array of parts with texts of their own.
    """

    name: str
    required: tuple[str, ...] = ()
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    each: tuple[str, str, str] | None = None
    optional: tuple[str, ...] = ()
    roles: tuple[tuple[str, str], ...] = ()

    def path_sets(self) -> list[tuple[str, ...]]:
        """The sets of paths that select this layout; fields it does not read have no influence."""
        if self.each:
            name, role, text = self.each
            contents = [(), (text,), (f"{text}[].text",), (f"{text}[].text", f"{text}[].type"), (f"{text}[]",)]
            cores = [tuple(f"{name}[].{x}" for x in (role, *content)) for content in contents]
        else:
            cores = [self.required]
        more = [x for n in range(len(self.optional) + 1) for x in combinations(self.optional, n)]
        return [tuple(sorted(core + x)) for core, x in product(cores, more)]


#: Layouts that public instruction and chat data come in.
LAYOUTS = (
    Layout("messages", each=("messages", "role", "content")),
    Layout("exchanges", each=("conversations", "from", "value"), roles=(("human", "user"), ("gpt", "assistant"))),
    Layout("response", ("prompt", "response"), (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))), optional=("system",)),
    Layout("completion", ("completion", "prompt"), (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",))), optional=("system",)),
    Layout("instruction", ("instruction", "output"), (("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",))),
           optional=("input", "system")),
    Layout("question", ("answer", "question"), (("system", ("system",)), ("user", ("context", "question")), ("assistant", ("answer",))),
           optional=("context", "system")),
)


Presence = Callable[[Column], Column]


def _below(name: str, there: Presence) -> Presence:
    return lambda v: there(v[name])


def _in_any(there: Presence) -> Presence:
    return lambda v: F.coalesce(F.exists(v, lambda x: there(x)), F.lit(False))


def _paths(kind: T.DataType, path: str) -> list[tuple[str, Presence]]:
    """Leaf paths below a value at any depth, each with the condition on the value that it is present."""
    if isinstance(kind, T.StructType):
        return [(p, _below(f.name, there)) for f in kind.fields for p, there in _paths(f.dataType, f"{path}.{f.name}")]
    if isinstance(kind, T.ArrayType):
        return [(p, _in_any(there)) for p, there in _paths(kind.elementType, f"{path}[]")]
    return [(path, lambda v: v.isNotNull())]


def field_paths(records: DataFrame, columns: list[str]) -> Column:
    """Sorted paths of the nested fields that are present in a record."""
    found = [(p, there(records[c])) for c in columns for p, there in _paths(records.schema[c].dataType, c)]
    found.sort(key=lambda x: x[0])
    return F.array_compact(F.array(*[F.when(there, F.lit(path)) for path, there in found]).cast("array<string>"))


def fingerprint(paths: Column) -> Column:
    """Schema fingerprint: a hash of the field paths."""
    return F.sha2(F.array_join(paths, "\n"), 256)


def _wrappers(kind: T.DataType, path: tuple[str, ...]) -> list[tuple[str, ...]]:
    """Paths of the structs at and below a value, outer ones first."""
    if not isinstance(kind, T.StructType):
        return []
    return [path] + [x for f in kind.fields for x in _wrappers(f.dataType, (*path, f.name))]


def _content(value: Column, kind: T.DataType) -> Column:
    """Text of a content: itself, or the texts of its parts joined by blank lines; parts without text have none."""
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, T.StructType):
            value = F.transform(value, lambda x: x.getField("text").cast("string"))
        value = F.array_join(value.cast("array<string>"), "\n\n")
    return F.coalesce(value.cast("string"), F.lit(""))


def _turns(fields: dict[str, tuple[Column, T.DataType]], layout: Layout) -> Column:
    """Turns of a layout whose fields are given by name."""
    if layout.each:
        name, role, text = layout.each
        items, kind = fields[name]

        def turn(x: Column) -> Column:
            given = F.coalesce(x.getField(role).cast("string"), F.lit(""))
            for old, new in layout.roles:
                given = F.when(given == F.lit(old), F.lit(new)).otherwise(given)
            content = _content(x.getField(text), kind.elementType[text].dataType) if text in kind.elementType.names else F.lit("")
            return F.struct(given.alias("role"), content.alias("text"))

        return F.transform(items, turn)
    found = []
    for role, names in layout.turns:
        texts = [fields[n][0].cast("string") for n in names if n in fields]
        if texts:
            turn = F.struct(F.lit(role).alias("role"), F.concat_ws("\n\n", *texts).alias("text"))
            found.append(F.when(F.coalesce(*texts).isNotNull(), turn))
    return F.array_compact(F.array(*found))


def canonical_turns(records: DataFrame, columns: list[str], layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Add ``fingerprint``, ``layout`` and ``turns`` to records.

    ``columns`` are those that hold the record; every other column is kept and has no influence.
    A record's fingerprint is the hash of the paths, at any depth, of its fields that are not null.
    Hashes of the paths that a layout reads select the mapping, so fields beside them do not matter;
    of several layouts the first in the list counts, and a record outside any struct before a
    wrapped one.  A record of no known layout keeps its row, with a null layout and no turns.

    Null texts inside an array of messages are empty texts; a content in parts is their texts joined
    by blank lines, without parts that have no text.  Columns called ``fingerprint``, ``layout`` or
    ``turns`` are replaced.
    """
    there = {p for c in columns for p, _ in _paths(records.schema[c].dataType, c)}
    out = records.withColumn("_paths", field_paths(records, columns))
    tops = {c: (records[c], records.schema[c].dataType) for c in columns}
    roots: list[tuple[str, dict]] = [("", tops)]
    for c in columns:
        for path in _wrappers(records.schema[c].dataType, (c,)):
            value, kind = records[c], records.schema[c].dataType
            for name in path[1:]:
                value, kind = value.getField(name), kind[name].dataType
            roots.append((".".join(path) + ".", {f.name: (value.getField(f.name), f.dataType) for f in kind.fields}))
    name, turns = F.lit(None).cast("string"), F.array().cast(TURNS)
    for root, fields in reversed(roots):
        for layout in reversed(layouts):
            sets = [tuple(root + p for p in paths) for paths in layout.path_sets()]
            sets = [paths for paths in sets if there.issuperset(paths)]
            if not sets:
                continue
            read = sorted({p for paths in sets for p in paths})
            own = fingerprint(F.array_intersect("_paths", F.array(*map(F.lit, read))))
            chosen = own.isin(*[hashlib.sha256("\n".join(paths).encode()).hexdigest() for paths in sets])
            name = F.when(chosen, F.lit(layout.name)).otherwise(name)
            turns = F.when(chosen, _turns(fields, layout).cast(TURNS)).otherwise(turns)
    return out.withColumns({"fingerprint": fingerprint(F.col("_paths")), "layout": name, "turns": turns}).drop("_paths")


def escape(text: Column) -> Column:
    """A text in which no control string is left; :func:`unescape` undoes it."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for plain, inside in CONTROL.items():
        out = F.replace(out, F.lit(plain), F.lit(inside))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once: inside a lambda a column's expression is computed for every element."""
    return F.element_at(F.transform(F.array(value), lambda x: body(x)), 1)


def _starts(lengths: Column) -> Column:
    """Where each of a row of texts starts when they are laid end to end.

    Arrays only grow by copies, so runs of lengths are summed one by one: the work grows with the
    lengths and hardly with their square.
    """

    def runs(all_lengths: Column) -> Column:
        last = F.floor(F.size(all_lengths) / F.lit(RUN)).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda r: F.slice(all_lengths, r * F.lit(RUN) + F.lit(1), F.lit(RUN)))

    def add(state: Column, run: Column) -> Column:
        sums = F.aggregate(run, F.array(state["at"]), lambda at, n: F.concat(at, F.array(F.element_at(at, -1) + n)))
        done = lambda x: F.concat(state["done"], F.array(F.slice(x, F.lit(1), F.size(x) - F.lit(1))))
        return _let(sums, lambda x: F.struct(F.element_at(x, -1).alias("at"), done(x).alias("done")))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<int>>").alias("done"))
    return F.flatten(F.aggregate(_let(lengths, runs), start, add, lambda state: state["done"]))


def format_turns(df: DataFrame, turns: str = "turns", learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Add ``formatted`` and ``loss_spans`` to rows with an array of turns.

    Turns are marked by control strings, which are escaped inside roles and texts.  ``loss_spans``
    are the texts to learn from: turn, start and length in ``formatted``, in code points.  Null
    roles and texts are empty; no turns give an empty string and no spans.
    """
    marked = F.transform(
        F.coalesce(F.col(turns), F.array().cast(TURNS)),
        lambda t: F.struct(
            t.role.alias("role"),
            F.concat(F.lit(OPEN), escape(F.coalesce(t.role, F.lit(""))), F.lit(CLOSE)).alias("head"),
            escape(F.coalesce(t.text, F.lit(""))).alias("body"),
        ),
    )
    df = df.withColumn("_marked", marked)
    starts = _starts(F.transform("_marked", lambda t: F.length(t["head"]) + F.length(t["body"]) + F.lit(len(END))))
    spans = F.transform(
        F.arrays_zip(F.col("_marked").alias("turn"), starts.alias("start")),
        lambda x, i: F.when(
            x["turn"]["role"].isin(*learn),
            F.struct(i.alias("turn"), (x["start"] + F.length(x["turn"]["head"])).alias("start"), F.length(x["turn"]["body"]).alias("length")),
        ),
    )
    text = F.array_join(F.transform(F.col("_marked"), lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")
    return df.withColumns({"formatted": text, "loss_spans": F.array_compact(spans)}).drop("_marked")


def read_back(df: DataFrame) -> DataFrame:
    """Add ``read_turns`` and ``loss_texts``, read from ``formatted`` and ``loss_spans`` alone.

    A loss text is what lies at its span's ``start``.  So that a long string is not counted through
    once for each span, it is looked for in the piece between control strings that ``start`` lies in,
    whose place is summed up anew from the pieces; a span that leaves its piece reads nothing beyond it.
    """
    parts = _let(F.split(F.col("formatted"), END), lambda x: F.slice(x, F.lit(1), F.size(x) - 1))
    df = df.withColumn("_parts", parts)
    cut = lambda part: F.locate(CLOSE, part)
    turns = F.transform(
        F.col("_parts"),
        lambda part: F.struct(
            unescape(F.substr(part, F.lit(len(OPEN) + 1), cut(part) - F.lit(len(OPEN) + 1))).alias("role"),
            unescape(F.substr(part, cut(part) + F.lit(len(CLOSE)))).alias("text"),
        ),
    )
    starts = _starts(F.transform("_parts", lambda part: F.length(part) + F.lit(len(END))))

    def learnt(x: Column) -> Column:
        piece = lambda s: F.substr(F.get(x["parts"], s["turn"]), s["start"] - F.get(x["starts"], s["turn"]) + F.lit(1), s["length"])
        return F.transform(x["spans"], lambda s: unescape(piece(s)))

    given = F.struct(F.col("_parts").alias("parts"), starts.alias("starts"), F.col("loss_spans").alias("spans"))
    return df.withColumns({"read_turns": turns, "loss_texts": _let(given, learnt)}).drop("_parts")


def conversation_records(conversations: DataFrame) -> DataFrame:
    """One record in the messages layout per ``conv_id``, from rows by turn.

    Turns are ordered by ``turn``, ties by role and text; nulls come first.  A conversation is one
    training string, so its rows meet in one record; null roles and texts are empty.
    """
    message = F.struct(
        F.col("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("content")
    )
    grouped = conversations.select("conv_id", message.alias("m")).groupBy("conv_id").agg(F.sort_array(F.collect_list("m")).alias("messages"))
    return grouped.select("conv_id", F.transform("messages", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"))


def dealt_records(records: DataFrame) -> DataFrame:
    """The same conversations in several layouts, by a hash of ``conv_id``.

    ``records`` has ``conv_id`` and ``messages``.  A conversation keeps its messages, or becomes
    exchanges below a struct (``chat``), messages with contents in parts below a struct (``parted``),
    or, where it is one question and one answer, ``prompt`` and ``response``.  Layouts that would
    change a role are not used for a conversation that has it.
    """
    roles = F.transform("messages", lambda m: m["role"])
    which = F.pmod(F.xxhash64("conv_id"), F.lit(4))
    pair = (which == 1) & (roles == F.array(F.lit("user"), F.lit("assistant")))
    named = (which == 2) & ~F.arrays_overlap(roles, F.array(F.lit("human"), F.lit("gpt")))
    renamed = lambda role: F.when(role == "user", F.lit("human")).when(role == "assistant", F.lit("gpt")).otherwise(role)
    exchanges = F.transform("messages", lambda m: F.struct(renamed(m["role"]).alias("from"), m["content"].alias("value")))
    part = lambda x: F.struct(F.lit("text").alias("type"), x.alias("text"))
    parted = F.transform(
        "messages", lambda m: F.struct(m["role"].alias("role"), F.transform(F.split(m["content"], "\n\n"), part).alias("content"))
    )
    return records.select(
        "conv_id",
        F.when(~pair & ~named & (which != 3), F.col("messages")).alias("messages"),
        F.when(named, F.struct(exchanges.alias("conversations"))).alias("chat"),
        F.when(which == 3, F.struct(parted.alias("messages"))).alias("parted"),
        F.when(pair, F.element_at("messages", 1)["content"]).alias("prompt"),
        F.when(pair, F.element_at("messages", 2)["content"]).alias("response"),
    )
