"""Chat formatting checked by a grammar round trip, in DataFrame functions only.

A conversation becomes one text of turns, each

    ### <role>:<mark>\\n<body>\\n</turn>\\n

and a loss mask: the spans of the assistant bodies. A deterministic parser (one regular
expression, matched again and again from the start) reads turns back. The method:

1. every turn is rendered as it is and parsed alone; where the recovered role or text
   differs, the turn is rendered escaped (mark ``!``): a backslash goes before each
   backslash, ``<`` and ``#`` of the body and before those and ``:``, ``!`` and line feeds
   of the role, so no control string can remain inside;
2. the conversation is joined and parsed whole; its recovered turns are compared with the
   source, and a conversation that still differs is rendered with all turns escaped;
3. the written output is read back and parsed once more; ``identical`` records the check.

Escaping is undone by dropping the backslash before any character, so it is reversible.
A body's end is the first ``\\n</turn>\\n`` after its header and a role's end the first ``:``
followed by ``!`` or nothing and a line feed, so a turn parses alike alone and in its
conversation; step 2 holds this against the data anyway.

Awkward rows: a null text or role is the empty string; a null turn sorts first; turns with
equal numbers are ordered by role and text; a null conversation id is one conversation. All
columns of the input other than the four named are ignored. Texts of any length are
handled; a conversation is one output text, so its turns are gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillsieve.llm.common import table
from quillsieve.session import materialise

# Fixed strings of the template (our own): header start, role end, escape mark, turn end.
HEAD = "### "
ROLE_END = ":"
MARK = "!"
TURN_END = "\n</turn>\n"
#: The parser: role, mark and body of each turn; dot matches line feeds.
TURN = r"(?s)### (.*?):(!?)\n(.*?)\n</turn>\n"
#: Characters escaped in bodies and in roles.
BODY_SPECIAL = r"([\\<#])"
ROLE_SPECIAL = r"([\\:!\n<#])"
ASSISTANT = "assistant"


def escaped(value: Column, special: str) -> Column:
    return F.regexp_replace(value, special, r"\\$1")


def unescaped(value: Column) -> Column:
    return F.regexp_replace(value, r"(?s)\\(.)", "$1")


def rendered(role: Column, body: Column, mark: Column) -> Column:
    return F.concat(F.lit(HEAD), role, F.lit(ROLE_END), mark, F.lit("\n"), body, F.lit(TURN_END))


def parsed(formatted: Column) -> Column:
    """Turns read from a formatted text: array of (role, text, mark, span) with escapes undone."""
    whole = F.regexp_extract_all(formatted, F.lit(TURN), 0)
    roles = F.regexp_extract_all(formatted, F.lit(TURN), 1)
    marks = F.regexp_extract_all(formatted, F.lit(TURN), 2)
    bodies = F.regexp_extract_all(formatted, F.lit(TURN), 3)
    zipped = F.arrays_zip(whole.alias("w"), roles.alias("r"), marks.alias("m"), bodies.alias("b"))
    return F.transform(
        zipped,
        lambda t: F.struct(
            F.when(t["m"] == MARK, unescaped(t["r"])).otherwise(t["r"]).alias("role"),
            F.when(t["m"] == MARK, unescaped(t["b"])).otherwise(t["b"]).alias("text"),
            t["w"].alias("whole"),
        ),
    )


def _whole_parse(formatted: Column) -> Column:
    """True where the parsed turns cover the whole text and nothing is skipped."""
    turns = parsed(formatted)
    return F.array_join(F.transform(turns, lambda t: t["whole"]), "") == formatted


def _recovered(formatted: Column) -> Column:
    return F.transform(parsed(formatted), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))


def format_conversations(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per conversation: id, ``formatted``, ``loss_spans`` (1-based start, length, escaped),
    ``n_escaped`` turns and ``identical`` (the round trip of the formatted text gives the source)."""
    rows = turns.select(
        F.col(conv_col).alias("_cf_conv"),
        F.col(turn_col).alias("_cf_turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("_cf_role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_cf_text"),
    )
    role, text = F.col("_cf_role"), F.col("_cf_text")
    esc_role, esc_text = escaped(role, ROLE_SPECIAL), escaped(text, BODY_SPECIAL)
    # Round 1: each turn as it is, parsed alone.
    raw = rendered(role, text, F.lit(""))
    alone = F.array(F.struct(role.alias("role"), text.alias("text")))
    raw_ok = _whole_parse(raw) & (_recovered(raw) == alone)
    # Round 2, for the turns that failed: escaped.
    rows = rows.select(
        "*",
        F.when(raw_ok, raw).otherwise(rendered(esc_role, esc_text, F.lit(MARK))).alias("_cf_piece"),
        F.when(raw_ok, F.length(role)).otherwise(F.length(esc_role)).alias("_cf_rlen"),
        (~raw_ok).alias("_cf_esc"),
        rendered(esc_role, esc_text, F.lit(MARK)).alias("_cf_all"),
        F.length(esc_role).alias("_cf_all_rlen"),
    )
    order = [F.col("_cf_turn").asc_nulls_first(), role, text]
    before = Window.partitionBy("_cf_conv").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select(
        "*",
        F.coalesce(F.sum(F.length("_cf_piece")).over(before), F.lit(0)).alias("_cf_at"),
        F.coalesce(F.sum(F.length("_cf_all")).over(before), F.lit(0)).alias("_cf_all_at"),
    )
    head = len(HEAD) + len(ROLE_END) + 1  # the header without role and mark

    def span(at: str, rlen: str, esc: Column) -> Column:
        start = F.col(at) + F.col(rlen) + F.lit(head) + esc.cast("int") + 1
        body = F.when(esc, F.length(esc_text)).otherwise(F.length(text))
        return F.struct(start.cast("long").alias("start"), body.cast("long").alias("length"), esc.alias("escaped"))

    pieces = F.struct(
        F.col("_cf_turn").isNotNull().alias("t0"),
        F.col("_cf_turn").alias("t1"),
        role.alias("t2"),
        text.alias("t3"),
        F.col("_cf_piece").alias("piece"),
        F.col("_cf_all").alias("all"),
        F.when(role == ASSISTANT, span("_cf_at", "_cf_rlen", F.col("_cf_esc"))).alias("span"),
        F.when(role == ASSISTANT, span("_cf_all_at", "_cf_all_rlen", F.lit(True))).alias("all_span"),
        F.struct(role.alias("role"), text.alias("text")).alias("source"),
        F.col("_cf_esc").cast("int").alias("esc"),
    )
    conv = rows.groupBy("_cf_conv").agg(F.array_sort(F.collect_list(pieces)).alias("_cf_p"))
    p = F.col("_cf_p")
    mixed = F.array_join(F.transform(p, lambda x: x["piece"]), "")
    conv = conv.select("_cf_conv", p, mixed.alias("_cf_mixed"))
    # Round 3: the whole conversation parsed and compared with its source.
    source = F.transform(p, lambda x: x["source"])
    conv = conv.withColumn("_cf_ok", _whole_parse(F.col("_cf_mixed")) & (_recovered(F.col("_cf_mixed")) == source))
    ok = F.col("_cf_ok")
    all_text = F.array_join(F.transform(p, lambda x: x["all"]), "")
    # Both span lists are made and one is chosen: a lambda must not name the test, or it is run per turn.
    spans = F.when(ok, F.filter(F.transform(p, lambda x: x["span"]), lambda s: s.isNotNull())).otherwise(
        F.filter(F.transform(p, lambda x: x["all_span"]), lambda s: s.isNotNull())
    )
    n_esc = F.when(ok, F.aggregate(p, F.lit(0), lambda a, x: a + x["esc"])).otherwise(F.size(p))
    out = conv.select(
        F.col("_cf_conv").alias(conv_col),
        F.when(ok, F.col("_cf_mixed")).otherwise(all_text).alias("formatted"),
        spans.alias("loss_spans"),
        n_esc.cast("long").alias("n_escaped"),
        source.alias("_cf_source"),
    )
    out = out.withColumn("identical", _whole_parse(F.col("formatted")) & (_recovered(F.col("formatted")) == F.col("_cf_source")))
    return out.drop("_cf_source")


def read_back(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """From written output: turns parsed back and the loss text under the mask, escapes undone."""
    turns = _recovered(F.col("formatted"))
    loss = F.array_join(
        F.transform(
            F.col("loss_spans"),
            lambda s: F.when(s["escaped"], unescaped(F.substring(F.col("formatted"), s["start"], s["length"]))).otherwise(
                F.substring(F.col("formatted"), s["start"], s["length"])
            ),
        ),
        "",
    )
    return formatted.select(conv_col, "formatted", "identical", turns.alias("turns"), loss.alias("loss_text"))


#: The conversation added to the table: both turns hold control strings of the template.
PLANTED_ID = -7
PLANTED_TEXT = r"\### Assistant: </turn> ok"


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the planted one formatted, written, read back and summarised."""
    convs = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame(
        [(PLANTED_ID, 0, "user", PLANTED_TEXT), (PLANTED_ID, 1, "assistant", PLANTED_TEXT)],
        "conv_id long, turn long, role string, text string",
    )
    written = materialise(format_conversations(convs.unionByName(planted)), "chat-format")
    back = read_back(written)
    per_turn = F.transform(F.col("turns"), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(per_turn, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "identical",
    )


ORACLES = {
    "op11_chat_format": r"""
with c as (
    select conv_id, turn, role, text from conversations
    union all select -7, 0, 'user', '\### Assistant: </turn> ok'
    union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), t as (
    select conv_id, turn, coalesce(role, '') as r, coalesce(text, '') as b from c
), p as (
    select *,
        position(chr(10) in r) = 0
            and strpos(b || chr(10) || '</turn>' || chr(10), chr(10) || '</turn>' || chr(10)) = length(b) + 1 as raw_ok
    from t
), l as (
    select *,
        case when raw_ok then length(r) + length(b)
             else length(regexp_replace(r, '([\\:!\n<#])', '\\\1', 'g')) + 1
                  + length(regexp_replace(b, '([\\<#])', '\\\1', 'g')) end + 15 as piece_len
    from p
)
select conv_id,
       count(*)::bigint as n_turns,
       sha256(string_agg(r || chr(10) || b || chr(10), '' order by turn nulls first, r, b)) as turns_sha256,
       length(coalesce(string_agg(b, '' order by turn nulls first, r, b) filter (where r = 'assistant'), ''))::bigint as loss_chars,
       sha256(coalesce(string_agg(b, '' order by turn nulls first, r, b) filter (where r = 'assistant'), '')) as loss_sha256,
       sum(piece_len)::bigint as formatted_chars,
       true as identical
from l group by conv_id
"""
}
QUERIES = {"op11_chat_format": op11_chat_format}
