"""Chat formatting with a grammar round trip: rendered text is parsed again and must give the source's turns.

A conversation becomes ``[INST]..[/INST]`` per user turn, ``<<SYS>>..<</SYS>>`` per system turn, ``<s>..</s>`` per
assistant turn, and ``[ROLE]name[/ROLE][TURN]..[/TURN]`` for any other role. The parser is deterministic: the
text is cut at the control strings, which have to come as pairs of an opening and its closing one with
nothing between pairs; what a pair encloses is a turn, unescaped. A turn that the parser doesn't give back from
its own rendering holds conflicting content and is escaped: one backslash goes behind the first
character of each control string in it, whether that has backslashes already or not, so that the parser
takes exactly one away. Then the whole conversation is parsed; should it still differ, all its turns are escaped, and a
conversation that differs even then fails the job instead of being written.

No control string holds the beginning of another, so what stands on both sides of a mark can't form one.

All expressions are Spark's own. Turns are judged and escaped row by row, and collected per task before the
shuffle; one conversation is one training sample and one value of at most 2 GB, as its digest asks.

Rows are ordered by turn, null turns first, ties by role and then by text; repeated rows are turns of their own. A null role
or text reads as empty, rows without conv_id are one conversation, an empty table gives none, and texts are
used whole. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Opening and closing control string per role.
MARKS = {
    "user": ("[INST]", "[/INST]"),
    "system": ("<<SYS>>", "<</SYS>>"),
    "assistant": ("<s>", "</s>"),
}
ROLE = ("[ROLE]", "[/ROLE]")
TURN = ("[TURN]", "[/TURN]")
LEARNED = "assistant"

_TAILS = r"(/?(?:INST|ROLE|TURN)\]|</?SYS>>|/?s>)"
#: A control string as the parser sees it.
CONTROL = r"\[/?(?:INST|ROLE|TURN)\]|<</?SYS>>|</?s>"
#: Something that is or was one, with any number of backslashes; and with one at least.
_ANY = r"([\[<])(\\*)" + _TAILS
_ESCAPED = r"([\[<])\\(\\*)" + _TAILS


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _ANY, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def _segment(text, loss=False) -> Column:
    text = F.lit(text) if isinstance(text, str) else text
    loss = loss if isinstance(loss, Column) else F.lit(loss)
    return F.struct(text.alias("text"), loss.alias("loss"))


def segments(role: Column, text: Column) -> Column:
    """The pieces a turn is rendered as; ``text`` is escaped already where it has to be."""
    other = [_segment(ROLE[0]), _segment(escape(role)), _segment(ROLE[1])]
    found = F.array(*other, _segment(TURN[0]), _segment(text), _segment(TURN[1]))
    for name, (opening, closing) in MARKS.items():
        usual = F.array(_segment(opening), _segment(text, role == LEARNED), _segment(closing))
        found = F.when(role == name, usual).otherwise(found)
    return found


def joined(parts: Column) -> Column:
    return F.array_join(F.transform(parts, lambda s: s["text"]), "")


def parsed(frame: DataFrame, rendered: Column, turns: str) -> DataFrame:
    """Add the turns (role, text) of a rendered conversation; null if it breaks the grammar.

    Each step is a column of its own, so that it is computed once, and each lambda reads its own
    element only: the work is linear in the text.
    """
    kept = [c for c in frame.columns if c != turns]
    steps = frame.withColumn("_text", rendered).withColumns(
        {
            "_marks": F.regexp_extract_all("_text", F.lit(CONTROL), F.lit(0)),
            "_texts": F.split("_text", CONTROL, -1),
        }
    )
    after = F.slice("_texts", F.lit(2), F.size("_marks"))
    steps = steps.withColumn("_cut", F.arrays_zip(F.col("_marks").alias("mark"), after.alias("after")))
    steps = steps.withColumns(
        {
            "_opened": F.filter("_cut", lambda _, i: i % 2 == 0),
            "_closed": F.filter("_cut", lambda _, i: i % 2 == 1),
        }
    )
    # What an opening mark follows: the list has one element more, which the slice takes away.
    before = F.concat(F.array(F.lit(None)), F.col("_opened"))
    pairs = F.arrays_zip(F.col("_opened").alias("o"), F.col("_closed").alias("c"), before.alias("b"))
    steps = steps.withColumn("_pairs", F.slice(pairs, F.lit(1), F.size("_opened")))
    named = F.get("_opened", F.size("_opened") - 1)["mark"] == ROLE[0]
    fits = (
        (F.size("_cut") % 2 == 0)
        & (F.get("_texts", F.lit(0)) == "")
        & ~F.coalesce(named, F.lit(False))
        & F.forall("_pairs", _fits)
    )
    found = F.transform(
        F.filter("_pairs", lambda p: p["o"]["mark"] != ROLE[0]),
        lambda p: F.struct(_role(p).alias("role"), unescape(p["o"]["after"]).alias("text")),
    )
    return steps.select(*kept, F.when(fits, found).alias(turns))


def _fits(pair: Column) -> Column:
    """An opening mark, its closing one and nothing behind; a name goes with a turn, and only so."""
    kinds = [*MARKS.values(), ROLE, TURN]
    closing = F.create_map(*[F.lit(x) for kind in kinds for x in kind])
    own = F.try_element_at(closing, pair["o"]["mark"])
    named = F.coalesce(pair["b"]["mark"] == ROLE[0], F.lit(False))
    return F.coalesce(
        (pair["c"]["mark"] == own)
        & (pair["c"]["after"] == "")
        & (named == (pair["o"]["mark"] == TURN[0])),
        F.lit(False),
    )


def _role(pair: Column) -> Column:
    found = unescape(pair["b"]["after"])
    for name, (opening, _) in MARKS.items():
        found = F.when(pair["o"]["mark"] == opening, F.lit(name)).otherwise(found)
    return found


def formatted(rows: DataFrame) -> DataFrame:
    """conv_id, formatted, segments (text, loss) that give it one after the other, and n_escaped turns."""
    role = F.coalesce(F.col("role"), F.lit("")).alias("role")
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    turns = rows.select("conv_id", "turn", role, text)
    turns = parsed(turns, joined(segments(F.col("role"), F.col("text"))), "alone")
    same = F.coalesce(F.col("alone") == F.array(F.struct("role", "text")), F.lit(False))
    turns = turns.withColumn("conflict", ~same)
    found = turns.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text", "conflict"))).alias("turns")
    )
    found = found.withColumn("n_escaped", F.size(F.filter("turns", lambda t: t["conflict"])))
    found = _attempt(found, lambda t: F.when(t["conflict"], escape(t["text"])).otherwise(t["text"]))
    # Conversations that read back stay as they are, and are null for the second attempt.
    missed = F.when(~F.col("same"), F.col("turns"))
    once = found.withColumns(
        {
            "kept": F.when(F.col("same"), F.col("segments")),
            "turns": missed,
            "n_escaped": F.coalesce(F.size(missed), "n_escaped"),
        }
    )
    again = _attempt(once, lambda t: escape(t["text"]))
    failed = F.raise_error(F.lit("a rendered conversation doesn't read back"))
    chosen = F.when(F.col("kept").isNotNull(), F.col("kept")).when(F.col("same"), F.col("segments"))
    again = again.withColumn("segments", chosen.otherwise(failed))
    return again.select("conv_id", joined(F.col("segments")).alias("formatted"), "segments", "n_escaped")


def _attempt(found: DataFrame, text_of) -> DataFrame:
    """Add ``segments`` rendered from ``turns``, and ``same``: whether they read back."""
    rendered = F.flatten(F.transform("turns", lambda t: segments(t["role"], text_of(t))))
    found = parsed(found.withColumn("segments", rendered), joined(F.col("segments")), "read")
    source = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return found.withColumn("same", F.coalesce(F.col("read") == source, F.lit(False))).drop("read")


def read_back(written: DataFrame) -> DataFrame:
    """``formatted``'s rows with the turns parsed from the text, and the text under the loss mask."""
    learned = F.filter("segments", lambda s: s["loss"])
    plain = F.array_join(F.transform(learned, lambda s: unescape(s["text"])), "")
    return parsed(written, F.col("formatted"), "turns").withColumn("loss_text", plain)


def digests(written: DataFrame) -> DataFrame:
    """A row per conversation: counts and digests of what is read back from ``formatted``'s rows."""
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    return read_back(written).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", line), ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.col("n_escaped").cast("long").alias("n_escaped"),
    )
