"""Chat records of many layouts, brought to canonical turns and one marked-up text with a loss mask.

A record is a JSON text. Its *schema fingerprint* is the hash of its nested field paths, whatever the values. Each
declared layout says which paths it has and how they become turns; a record is read by the layout that has its
fingerprint. No layout is tried out by parsing: a record is parsed once, and one comparison of numbers chooses.

The text of a conversation is ``<turn ROLE>TEXT</turn>\\n`` for each turn, with ``&``, ``<`` and ``>`` escaped in
roles and texts, so nothing inside them reads as a mark, and undoing the escape gives them back exactly.

Results in odd cases: a null record, one that is not JSON, and one of no declared layout get a null layout and null
turns, and are never dropped; null roles and texts count as empty; a record too large for the parser of variants
(strings over 20 million characters, or 128 MB in all) is read by the JSON reader without that limit; rows may repeat and are formatted each; other columns stay beside the result, which is refused if it would hide one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cloakframe.llm.common import let

# Names that other layouts use for the canonical roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
TURNS = "array<struct<role:string,text:string>>"
# Characters from which on a record may be too large to be parsed as a variant.
LARGE = 20_000_000
# Turns of a conversation that one record holds at most when rows become records.
BLOCK = 256


@dataclass(frozen=True)
class Layout:
    """``turns`` are (role, paths) for fields that hold one turn each, several paths being joined by a blank line;
    ``many`` is (array field, role field, text field) for a list of turns."""

    name: str
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    many: tuple[str, str, str] | None = None
    renames: bool = False  # its roles have the names in ROLES

    def paths(self) -> list[str]:
        if self.many:
            field, role, text = self.many
            return sorted([f"{field}[].{role}", f"{field}[].{text}"])
        return sorted(path for _, paths in self.turns for path in paths)

    def read(self, record: Column) -> Column:
        if self.many:
            field, role, text = self.many
            kind = f"array<struct<`{role}`:string,`{text}`:string>>"
            held = F.try_variant_get(record, f"$.{field}", kind)
            return F.transform(held, lambda x: _turn(self.role(x[role]), x[text]))
        one = [
            _turn(F.lit(role), F.concat_ws("\n\n", *[F.try_variant_get(record, f"$.{p}", "string") for p in paths]))
            for role, paths in self.turns
        ]
        return F.array(*one)

    def role(self, name: Column) -> Column:
        for other, canonical in ROLES.items() if self.renames else ():
            name = F.when(name == other, canonical).otherwise(name)
        return name


    def read_large(self, record: Column) -> tuple[Column, Column]:
        """Whether a JSON text has this layout, and its turns, by the JSON reader."""
        top = _json(record, "map<string,string>")
        if self.many:
            field, role, text = self.many
            held = _json(top[field], "array<map<string,string>>")
            named = F.array_sort(F.array_distinct(F.flatten(F.transform(held, lambda x: F.map_keys(x)))))
            same = _has_names(F.map_keys(top), [field]) & _has_names(named, [role, text])
            return same, F.transform(held, lambda x: _turn(self.role(x[role]), x[text]))
        parents = {p.split(".")[0] for p in self.paths() if "." in p}
        inner = {p: _json(top[p], "map<string,string>") for p in parents}
        same = _has_names(F.map_keys(top), [p.split(".")[0] for p in self.paths()])
        for parent, found in inner.items():
            same = same & _has_names(F.map_keys(found), [p.split(".")[1] for p in self.paths() if p.startswith(f"{parent}.")])
        at = lambda p: inner[p.split(".")[0]][p.split(".")[1]] if "." in p else top[p]
        return same, F.array(*[_turn(F.lit(r), F.concat_ws("\n\n", *[at(p) for p in paths])) for r, paths in self.turns])


def _json(text: Column, kind: str) -> Column:
    return F.from_json(text, kind, {"maxStringLen": str(2**31 - 1)})


def _has_names(names: Column, wanted: list[str]) -> Column:
    return F.coalesce(F.array_sort(names) == F.array(*[F.lit(w) for w in sorted(set(wanted))]), F.lit(False))


def _one(name: str, *turns: tuple[str, str]) -> Layout:
    return Layout(name, tuple((role, tuple(paths.split("+"))) for role, paths in turns))


LAYOUTS = (
    Layout("messages", many=("messages", "role", "content")),
    Layout("conversations", many=("conversations", "from", "value"), renames=True),
    Layout("turns", many=("turns", "role", "text")),
    _one("prompt_response", ("user", "prompt"), ("assistant", "response")),
    _one("prompt_completion", ("user", "prompt"), ("assistant", "completion")),
    _one("system_prompt_response", ("system", "system"), ("user", "prompt"), ("assistant", "response")),
    _one("instruction", ("user", "instruction"), ("assistant", "output")),
    _one("instruction_input", ("user", "instruction+input"), ("assistant", "output")),
    _one("question_answer", ("user", "question"), ("assistant", "answer")),
    _one("nested_pair", ("user", "data.prompt"), ("assistant", "data.response")),
)


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def path_text(record: Column) -> Column:
    """The nested field paths of a parsed record as one text, without the kinds of the values."""
    kinds = r"VOID|BOOLEAN|BIGINT|DECIMAL\(\d+,\d+\)|DOUBLE|FLOAT|STRING|DATE|TIMESTAMP(?:_NTZ)?|BINARY|UUID|VARIANT"
    return F.regexp_replace(F.schema_of_variant(record), rf": (?:{kinds})(?=[,>])", "")


def declared_path_text(paths: list[str]) -> str:
    """What ``path_text`` gives for records with these paths."""
    tree: dict = {}
    for path in paths:
        node = tree
        for step in path.replace("[]", ".[]").split("."):
            node = node.setdefault(step, {})

    def text(node: dict) -> str:
        if "[]" in node:
            return f"ARRAY<{text(node['[]'])}>"
        return "OBJECT<" + ", ".join(f"{k}: {text(v)}" if v else k for k, v in sorted(node.items())) + ">"

    return text(tree)


def fingerprint(record: Column) -> Column:
    return F.xxhash64(path_text(record))


def canonical_turns(records: DataFrame, record_col: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """The rows with ``layout`` and ``turns``, an array of (role, text)."""
    _refuse(records, "layout", "turns")
    parsed = records.withColumn("__parsed", F.try_parse_json(record_col)).withColumn(
        "__print", fingerprint(F.col("__parsed"))
    )
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for known in layouts:
        same = F.col("__print") == F.xxhash64(F.lit(declared_path_text(known.paths())))
        layout = F.when(same, known.name).otherwise(layout)
        turns = F.when(same, known.read(F.col("__parsed"))).otherwise(turns)
    refused = F.col("__parsed").isNull() & (F.length(record_col) >= LARGE)
    for known in layouts:
        same, read = known.read_large(F.col(record_col))
        layout = F.when(refused & same, known.name).otherwise(layout)
        turns = F.when(refused & same, read).otherwise(turns)
    return parsed.withColumns({"layout": layout, "turns": turns}).drop("__parsed", "__print")


def _refuse(df: DataFrame, *names: str) -> None:
    clash = {c.lower() for c in df.columns} & set(names)
    if clash:
        raise ValueError(f"input columns would be hidden: {sorted(clash)}")


def escape(text: Column) -> Column:
    for plain, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for plain, safe in ((">", "&gt;"), ("<", "&lt;"), ("&", "&amp;")):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def format_turns(df: DataFrame, turns_col: str = "turns", learn: str = "assistant") -> DataFrame:
    """The rows with ``formatted`` and ``loss_spans``: (start, length) in characters of the escaped texts of the
    role that is learned."""
    _refuse(df, "formatted", "loss_spans")
    pieces = F.transform(
        turns_col,
        lambda t: F.struct(
            F.concat(F.lit("<turn "), escape(t["role"]), F.lit(">")).alias("head"),
            escape(t["text"]).alias("text"),
            (t["role"] == learn).alias("learned"),
        ),
    )
    end = F.lit("</turn>\n")
    marked = df.withColumn("__pieces", pieces).withColumn(
        "formatted", F.array_join(F.transform("__pieces", lambda p: F.concat(p["head"], p["text"], end)), "")
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    swept = F.aggregate(
        "__pieces",
        start,
        lambda a, p: F.struct(
            (a["at"] + F.length(p["head"]) + F.length(p["text"]) + len("</turn>\n")).alias("at"),
            F.when(
                p["learned"],
                F.concat(
                    a["spans"],
                    F.array(F.struct((a["at"] + F.length(p["head"])).alias("start"), F.length(p["text"]).alias("length"))),
                ),
            )
            .otherwise(a["spans"])
            .alias("spans"),
        ),
    )
    return marked.withColumn("loss_spans", swept["spans"]).drop("__pieces")


def read_turns(formatted: Column) -> Column:
    """The (role, text) turns of a formatted text."""

    def turn(piece: Column) -> Column:
        close = F.locate(">", piece)
        start = len("<turn ") + 1
        return F.struct(
            unescape(F.substring(piece, F.lit(start), close - start)).alias("role"),
            unescape(F.substr(piece, close + 1)).alias("text"),
        )

    # Each piece ends with the end mark, so the last part of the split is empty.
    return let(F.split(formatted, "</turn>\n"), lambda x: F.transform(F.slice(x, 1, F.size(x) - 1), turn))


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["length"]))), "")


def rows_to_records(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One JSON record per conversation and block of ``BLOCK`` turn numbers: (conv, block, record).

    A block is one group, so a conversation with a large part of all rows is spread over many tasks. Turns are in
    the order of turn number, role and text; a null number comes first. A user's turn answered once becomes a
    prompt and a response, after a system turn where there is one; any other block a list of messages.
    """
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(role_col, F.lit("")).alias("role"),
        F.coalesce(text_col, F.lit("")).alias("content"),
    )
    blocks = (
        rows.select(
            F.col(conv_col).alias("conv"),
            F.coalesce(F.floor(F.col(turn_col) / BLOCK), F.lit(-(2**62))).cast("long").alias("block"),
            turn.alias("one"),
        )
        .groupBy("conv", "block")
        .agg(F.sort_array(F.collect_list("one")).alias("m"))
    )
    roles, said = F.array_join("m.role", ","), lambda i: F.col("m")[i]["content"]
    record = (
        F.when((F.size("m") == 2) & (roles == "user,assistant"), F.to_json(F.struct(said(0).alias("prompt"), said(1).alias("response"))))
        .when(
            (F.size("m") == 3) & (roles == "system,user,assistant"),
            F.to_json(F.struct(said(0).alias("system"), said(1).alias("prompt"), said(2).alias("response"))),
        )
        .otherwise(
            F.to_json(
                F.struct(F.transform("m", lambda x: F.struct(x["role"], x["content"])).alias("messages"))
            )
        )
    )
    return blocks.select("conv", "block", record.alias("record"))
