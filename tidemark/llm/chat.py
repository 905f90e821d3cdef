"""Chat formatting: records of many layouts become turns, turns become a template with a loss mask."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Part:
    """Where turns come from: one text at ``path`` with a fixed role, or a list there with a role and a text field.

    ``piece`` is the field of a text that comes as a list of pieces, which are joined by line breaks; ``also`` the path of a second
    text of the same turn, which follows after an empty line unless it is empty.
    """

    path: str
    role: str | None = None
    role_field: str | None = None
    text_field: str | None = None
    roles: tuple[tuple[str, str], ...] = ()  # names of roles here, and what they are called in turns
    piece: str | None = None
    also: str | None = None


@dataclass(frozen=True)
class Layout:
    """A declarative mapping: the known field paths of records of this layout (one or more forms), how to read them, and the parts in order of turns."""

    name: str
    forms: tuple[str, ...]
    schema: str
    parts: tuple[Part, ...]


def _messages(name: str, role_field: str, text_field: str, *roles: tuple[str, str], path: str = "", piece: str | None = None, before: tuple[Part, ...] = ()) -> Layout:
    """A list of messages under the last field of ``path``, maybe with single texts beside it."""
    *outer, last = (path or name).split(".")
    text = f"{text_field}: ARRAY<OBJECT<{piece}>>" if piece else text_field
    inside = {role_field: role_field, text_field: text}
    listed = [f"ARRAY<OBJECT<{', '.join(inside[field] for field in sorted(inside))}>>", "ARRAY<>"]
    kind = f"array<struct<`{piece}`:string>>" if piece else "string"
    schema = f"array<struct<`{role_field}`:string,`{text_field}`:{kind}>>"
    beside = [part.path for part in before]
    forms = [f"OBJECT<{', '.join(sorted([*beside, f'{last}: {form}']))}>" for form in (listed[:1] if piece else listed)]
    for field in reversed(outer):
        forms, schema, last = [f"OBJECT<{field}: {form}>" for form in forms], f"struct<`{last}`:{schema}>", field
    fields = ", ".join([*[f"`{field}` string" for field in beside], f"`{last}` {schema}"])
    part = Part(path or name, role_field=role_field, text_field=text_field, roles=roles, piece=piece)
    return Layout(name, tuple(forms), fields, (*before, part))


def _fields(name: str, *parts: Part) -> Layout:
    fields = sorted(field for part in parts for field in (part.path, part.also) if field)
    return Layout(name, (f"OBJECT<{', '.join(fields)}>",), ", ".join(f"`{field}` string" for field in fields), parts)


LAYOUTS = (
    _messages("messages", "role", "content"),
    _messages("messages_system", "role", "content", path="messages", before=(Part("system", "system"),)),
    _messages("messages_pieces", "role", "content", path="messages", piece="text"),
    _messages("messages_inside", "role", "content", path="data.messages"),
    _messages("conversations", "from", "value", ("human", "user"), ("gpt", "assistant")),
    _messages("conversations_system", "from", "value", ("human", "user"), ("gpt", "assistant"), path="conversations", before=(Part("system", "system"),)),
    _fields("prompt", Part("prompt", "user"), Part("completion", "assistant")),
    _fields("prompt_system", Part("system", "system"), Part("prompt", "user"), Part("completion", "assistant")),
    _fields("instruction", Part("instruction", "user"), Part("output", "assistant")),
    _fields("instruction_input", Part("instruction", "user", also="input"), Part("output", "assistant")),
)
#: Containers that no layout knows are looked through, as they may hold such names as well, to this depth.
DEPTH = 4


def _skeleton(record: Column) -> Column:
    """The record with empty texts: its field paths, and whether it is JSON, can be told from that at any length.

    A VARIANT takes no text of over 20,000,000 characters and nothing over 128 MiB. Escapes in names become "?".
    """
    plain = F.regexp_replace(record, r"(?s)\\.", "?")
    return F.regexp_replace(plain, r'("[^"]*+"\s*+:)|(")[^"]*+(")', "$1$2$3")


def field_paths(record: Column) -> Column:
    """The nested field paths of a VARIANT record, sorted, without the types of the values at their ends."""
    paths = F.schema_of_variant(record)
    paths = F.regexp_replace(paths, r": (?!ARRAY<|OBJECT<)[A-Z_]+(\([0-9, ]*\))?", "")
    return F.regexp_replace(paths, r"(?<=<)(?!OBJECT<|ARRAY<)[A-Z_]+(\([0-9, ]*\))?(?=>)", "")


def known_paths(paths: Column, names: frozenset[str]) -> Column:
    """The field paths without those whose name is not among ``names``, such as ids, weights and sources."""
    inside = "(?:OBJECT<[^<>]*>|[^<>]*)"
    container = f"(?:: (?:ARRAY<ARRAY<{inside}>>|ARRAY<{inside}>|OBJECT<[^<>]*>))?"
    unknown = rf"(?<=<|, )(?!(?:{'|'.join(sorted(names))})(?:[,>]|: ))[^<>,:]+{container}(?=[,>])"
    for _ in range(DEPTH):
        paths = F.regexp_replace(paths, unknown, "")
        paths = F.regexp_replace(F.regexp_replace(paths, r"(?<=<)(?:, )+|(?:, )+(?=>)", ""), r"(?:, ){2,}", ", ")
    return paths


def fingerprint(paths: Column) -> Column:
    return F.sha2(paths, 256)


def names_of(layouts: tuple[Layout, ...]) -> frozenset[str]:
    return frozenset(re.findall(r"[a-z_]+", " ".join(form for layout in layouts for form in layout.forms)))


def canonical_turns(records: DataFrame, record_column: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Adds ``layout`` (name) and ``turns`` (array of role, text) to rows whose ``record`` is a JSON text.

    The layout is chosen by the SHA-256 of the record's nested field paths. Types do not count, and neither do fields whose
    name occurs in no layout. Texts are read as they are written; numbers and truth values become the texts that Spark's JSON
    reader gives them (1.50 becomes 1.5, 1.0 stays). Records of all lengths take the same way. Nulls in texts and roles become empty texts. A list where other messages have a text is taken as
    its JSON text. An empty list of messages gives no turns. A record of no known layout, with a field twice, or with an escape in
    a name, or a null or broken one, has null layout and turns. Columns named ``layout`` or ``turns`` are replaced, all others
    stay, whatever their names.
    """
    record, work = F.col(record_column), free_name(records)
    names = names_of(layouts)
    # One list of paths for each record, which all layouts are held against.
    prints = F.struct(fingerprint(known_paths(field_paths(F.try_parse_json(_skeleton(record))), names)).alias("print"))
    marked = records.withColumn(work, prints)
    name, turns = F.lit(None).cast("string"), F.lit(None).cast("array<struct<role:string,text:string>>")
    for layout in layouts:
        chosen = F.col(f"{work}.print").isin(*[hashlib.sha256(form.encode()).hexdigest() for form in layout.forms])
        name = F.when(chosen, layout.name).otherwise(name)
        turns = F.when(chosen, _read_turns(record, layout)).otherwise(turns)
    found = marked.withColumn(work, F.struct(name.alias("name"), turns.alias("turns")))
    read = F.col(f"{work}.turns")
    return found.withColumns({"layout": F.when(read.isNotNull(), F.col(f"{work}.name")), "turns": read}).drop(work)


def free_name(df: DataFrame) -> str:
    """A name that no column of ``df`` has, in whatever case."""
    taken, name = {column.lower() for column in df.columns}, "work_"
    while name in taken:
        name += "_"
    return name


def _read_turns(record: Column, layout: Layout) -> Column:
    """The turns of a record of this layout; null if it does not parse."""
    options = {"maxStringLen": str(2**31 - 1), "columnNameOfCorruptRecord": "broken__"}

    def turns(whole: Column) -> Column:
        return F.when(whole["broken__"].isNull(), F.concat(*[_turns(part, whole) for part in layout.parts]))

    parsed = F.from_json(record, f"{layout.schema}, broken__ string", options)
    return F.get(F.transform(F.array(parsed), turns), F.lit(0))


def _turns(part: Part, whole: Column) -> Column:
    value = whole
    for field in part.path.split("."):
        value = value[field]
    if part.role is not None:
        text = F.coalesce(value, F.lit(""))
        if part.also:
            also = F.coalesce(whole[part.also], F.lit(""))
            text = F.when(also != "", F.concat(text, F.lit("\n\n"), also)).otherwise(text)
        return F.array(F.struct(F.lit(part.role).alias("role"), text.alias("text")))

    def turn(message: Column) -> Column:
        role, text = F.coalesce(message[part.role_field], F.lit("")), message[part.text_field]
        if part.piece:
            text = F.array_join(F.transform(text, lambda piece: piece[part.piece]), "\n")
        return F.struct(_renamed(role, dict(part.roles)).alias("role"), F.coalesce(text, F.lit("")).alias("text"))

    return F.transform(value, turn)


# The template: <turn ROLE>TEXT</turn> and a line break for each turn. No "<" or ">" inside a role or text survives escaping,
# so its marks cannot occur there.
OPEN, MIDDLE, CLOSE = "<turn ", ">", "</turn>\n"


def escape(text: str) -> str:
    r"""Reversibly rids a text of the characters that marks are made of: \ becomes \b, < becomes \l, > becomes \g."""
    return text.replace("\\", "\\b").replace("<", "\\l").replace(">", "\\g")


def unescape(text: str) -> str:
    return text.replace("\\l", "<").replace("\\g", ">").replace("\\b", "\\")


FORMATTED = "formatted string, loss_spans array<struct<start:int,end:int>>"
READ = "turns array<struct<role:string,text:string>>, loss_text string"


def _format(turns: pd.Series) -> pd.DataFrame:
    rows = []
    for conversation in turns:
        pieces, spans, at = [], [], 0
        for turn in conversation:
            head, body = OPEN + escape(turn["role"]) + MIDDLE, escape(turn["text"])
            if turn["role"] == "assistant":
                spans.append({"start": at + len(head), "end": at + len(head) + len(body)})
            pieces += [head, body, CLOSE]
            at += len(head) + len(body) + len(CLOSE)
        rows.append(("".join(pieces), spans))
    return pd.DataFrame(rows, columns=["formatted", "loss_spans"])


def _read(formatted: pd.Series, loss_spans: pd.Series) -> pd.DataFrame:
    rows = []
    for text, spans in zip(formatted, loss_spans):
        turns = []
        for piece in text.split(CLOSE)[:-1]:
            role, body = piece.removeprefix(OPEN).split(MIDDLE, 1)
            turns.append({"role": unescape(role), "text": unescape(body)})
        rows.append((turns, "".join(unescape(text[span["start"] : span["end"]]) for span in spans)))
    return pd.DataFrame(rows, columns=["turns", "loss_text"])


def format_chats(chats: DataFrame, turns_column: str = "turns") -> DataFrame:
    """Adds (or replaces) ``formatted`` and ``loss_spans`` (start and exclusive end in code points of what assistants say, escaped).

    Rows with null turns have a null text and no spans; no turns give an empty text.
    """
    turns, work = F.coalesce(F.col(turns_column), F.array().cast("array<struct<role:string,text:string>>")), free_name(chats)
    made = chats.withColumn(work, F.pandas_udf(_format, FORMATTED)(turns))
    formatted = F.when(F.col(turns_column).isNotNull(), F.col(f"{work}.formatted"))
    return made.withColumns({"formatted": formatted, "loss_spans": F.col(f"{work}.loss_spans")}).drop(work)


def read_chats(chats: DataFrame) -> DataFrame:
    """From ``formatted`` and ``loss_spans`` the columns read_turns and loss_text, unescaped."""
    read = F.pandas_udf(_read, READ)(F.coalesce("formatted", F.lit("")), F.coalesce("loss_spans", F.array().cast("array<struct<start:int,end:int>>")))
    work = free_name(chats)
    return chats.withColumn(work, read).withColumns({"read_turns": F.col(f"{work}.turns"), "loss_text": F.col(f"{work}.loss_text")}).drop(work)


def _renamed(role: Column, names: dict[str, str]) -> Column:
    renamed = role
    for name, other in names.items():
        renamed = F.when(role == name, other).otherwise(renamed)
    return renamed


def as_records(rows: DataFrame) -> DataFrame:
    """(conv_id, record): rows of (conv_id, turn, role, text) as one JSON record per conversation, in its natural layout.

    A single exchange of a user and an assistant becomes a prompt or, if a system text leads it, a prompt with that;
    an exchange whose question is one line becomes an instruction; longer conversations become messages, those of
    the three usual roles that begin with a system text in the from/value form, where users are human and assistants
    gpt. Turns are ordered by turn, role and text. Null roles and texts become empty. Rows with a null conv_id are one
    conversation. Other columns are ignored.
    """
    said = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = F.array_sort(F.collect_list(said))
    chats = rows.groupBy("conv_id").agg(turns.alias("t"))
    roles, text = F.transform("t", lambda x: x["role"]), F.transform("t", lambda x: x["text"])

    def record(*pairs: tuple[str, int]) -> Column:
        return F.to_json(F.struct(*[F.get(text, F.lit(i)).alias(name) for name, i in pairs]))

    exchange = roles == F.array(F.lit("user"), F.lit("assistant"))
    with_system = roles == F.array(F.lit("system"), F.lit("user"), F.lit("assistant"))
    messages = F.to_json(F.struct(F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content"))).alias("messages")))
    names = {"system": "system", "user": "human", "assistant": "gpt"}
    usual = F.forall("t", lambda x: x["role"].isin(*names))
    told = F.to_json(F.struct(F.transform("t", lambda x: F.struct(_renamed(x["role"], names).alias("from"), x["text"].alias("value"))).alias("conversations")))
    chosen = (
        F.when(exchange & ~F.contains(F.get(text, F.lit(0)), F.lit("\n")), record(("instruction", 0), ("output", 1)))
        .when(exchange, record(("prompt", 0), ("completion", 1)))
        .when(with_system, record(("system", 0), ("prompt", 1), ("completion", 2)))
        .when((F.get(roles, F.lit(0)) == "system") & usual, told)
        .otherwise(messages)
    )
    return chats.select("conv_id", chosen.alias("record"))
