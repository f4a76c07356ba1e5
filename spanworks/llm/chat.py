"""Chat formatting into budgeted windows of whole turns, with a loss mask.

Prefix sums of the turns' tokens choose the windows.  Every window has the system turn that holds for it: the last
one before its first new turn, repeated unless it is new there itself.  A window's budget is ``target`` + ``history`` tokens; the
longest system turn of the conversation is set aside from ``target``, and what it leaves is for new turns, but half of ``target`` at least,
so that in a conversation with a longer system turn the budget is that turn, half of ``target`` and ``history``.  The token line
behind a leading system turn is cut into blocks of that size; the turns inside a block are one window, and a turn
across a cut is a window of its own, so that no window exceeds its budget unless a
single turn does.  As many of the turns just before it as ``history`` tokens hold are repeated; what is
repeated carries no loss.  Conversations of any length are dealt over many tasks, and
texts join the windows at the end only.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n``.  Inside texts and roles every ``<|`` gets a
backslash after the ``<`` (and ``<\\|`` one more, and so on), so that control
strings come from the template alone and the text can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanworks.operators.ordered import running
from spanworks.session import ensure_checkpoints

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: Budgets in tokens: the new turns of a window, and the repeated ones.  A token counts four bytes of text.
TARGET, HISTORY = 1536, 256
#: Tokens that the template adds to a turn.
OVERHEAD = 6
#: Pieces of a conversation that are put together first, in windows.
PIECE = 256


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def turn_tokens(role: Column, text: Column) -> Column:
    return (F.ceil((F.octet_length(role) + F.octet_length(text)) / F.lit(4)) + F.lit(OVERHEAD)).cast("bigint")


def windows(turns: DataFrame, target: int = TARGET, history: int = HISTORY) -> DataFrame:
    """One row per window: ``conv_id``, ``window``, ``n_context`` (repeated turns), ``n_turns``, ``text``,
    ``loss`` (character spans [from, to) of assistant texts that are new here), ``n_tokens``.

    Turns are ordered by ``turn``, then role and a hash of the text; null roles and texts are empty; a null
    ``conv_id`` is a conversation, a null ``turn`` comes first; repeated rows are turns each;
    an empty table gives no rows; other columns are ignored.
    """
    if not 0 <= history <= target:
        raise ValueError("history must be between 0 and target")
    ensure_checkpoints(turns.sparkSession)
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text")).select("*", F.xxhash64("text").alias("hash"), turn_tokens(F.col("role"), F.col("text")).alias("tokens"))
    key = ["conv_id", "turn", "role", "hash", "tokens"]
    said = rows.groupBy(*key).agg(F.max("text").alias("text"), F.count("*").alias("copies")).checkpoint()
    each = said.select(*key, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy")).drop("copy")
    placed = running(each, ["conv_id"], ["turn", "role", "hash"], {"at": F.col("tokens"), "systems": (F.col("role") == "system").cast("bigint")}, number="no").withColumn("to", F.col("at") + F.col("tokens")).checkpoint()

    # the room of new turns, and where the cuts start, follow from the system turns: a row for each conversation that has any
    system = F.col("role") == "system"
    lead = placed.where(system).groupBy(F.col("conv_id").alias("_c")).agg(F.max("tokens").alias("longest"), F.max(F.when(F.col("no") == 0, F.col("to"))).alias("lead"))
    known = placed.join(lead, placed["conv_id"].eqNullSafe(lead["_c"]), "left").drop("_c")
    room = F.greatest(F.lit(target) - F.coalesce("longest", F.lit(0)), F.lit(target - target // 2))
    known = known.withColumns({"skip": F.coalesce("lead", F.lit(0)), "is_lead": (F.col("no") == 0) & system, "room": room})
    cell = lambda x: F.floor((x - F.col("skip")) / F.col("room"))
    crosses = F.when(cell(F.col("at")) == cell(F.col("to") - 1), 0).otherwise(1)
    known = known.withColumn("window", F.when(F.col("is_lead"), 0).otherwise(2 * cell(F.col("at")) + crosses).cast("bigint")).drop("longest", "lead")

    # where each window starts; a turn belongs to the history of windows that start at `to` up to `at + history`
    begun = known.where("not is_lead")
    first = F.min(F.struct("no", "at", "systems", "role")).alias("first")
    starts = begun.groupBy("conv_id", "window", "skip", "room").agg(first).select("conv_id", "window", "skip", "room", F.col("first.at").alias("start"), F.when(F.col("first.role") != "system", F.col("first.systems") - 1).alias("holds"))
    narrow = ["turn", "role", "hash", "tokens"]
    parts = known.select("conv_id", "window", "no", *narrow, F.lit(False).alias("repeated"))
    if history:
        w = starts.select(F.col("conv_id").alias("_c"), F.col("window").alias("_w"), "start", "holds", cell(F.col("start")).alias("_cell"))
        reach = begun.where(F.col("tokens") <= history).withColumn("cell", F.explode(F.sequence(cell(F.col("to")), cell(F.col("at") + history))))
        before = reach.join(w, reach["conv_id"].eqNullSafe(w["_c"]) & (reach["cell"] == w["_cell"]) & (F.col("to") <= F.col("start")) & (F.col("at") >= F.col("start") - history))
        before = before.where(~system | ~F.col("systems").eqNullSafe(F.col("holds")))
        parts = parts.union(before.select("conv_id", F.col("_w").alias("window"), "no", *narrow, F.lit(True).alias("repeated")))
    # the system turn that holds, unless it is the leading one and the window the first
    told = known.where(system).select(F.col("conv_id").alias("_c"), F.col("systems").alias("_s"), "no", *narrow)
    later = starts.where("holds >= 0 and not (window = 0 and holds = 0 and skip > 0)").join(told, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("holds") == F.col("_s")))
    parts = parts.union(later.select("conv_id", "window", "no", *narrow, F.lit(True).alias("repeated")))

    shown = F.struct(
        "no", "repeated", (F.col("role") == "assistant").alias("speaks"), F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n")).alias("head"),
        escape(F.col("text")).alias("body"), "tokens",
    )
    t = said.drop("copies").toDF(*[f"_{c}" for c in key], "text")
    same = F.lit(True)
    for c in key:
        same = same & parts[c].eqNullSafe(t[f"_{c}"])
    grouped = parts.join(t, same).groupBy("conv_id", "window").agg(F.array_sort(F.collect_list(shown)).alias("t"))
    tail = f"{CLOSE}\n"

    def spans(acc: Column, x: Column) -> Column:
        begin = acc["n"] + F.length(x["head"])
        end = begin + F.length(x["body"])
        hit = x["speaks"] & ~x["repeated"]
        return F.struct((end + len(tail)).alias("n"), F.when(hit, F.concat(acc["s"], F.array(F.struct(begin.alias("from"), end.alias("to"))))).otherwise(acc["s"]).alias("s"))

    start = F.struct(F.lit(0).alias("n"), F.array().cast("array<struct<from:int,to:int>>").alias("s"))
    return grouped.select(
        "conv_id", "window",
        F.size(F.filter("t", lambda x: x["repeated"])).alias("n_context"), F.size("t").alias("n_turns"),
        F.array_join(F.transform("t", lambda x: F.concat(x["head"], x["body"], F.lit(tail))), "").alias("text"),
        F.aggregate("t", start, spans)["s"].alias("loss"),
        F.aggregate("t", F.lit(0).cast("bigint"), lambda a, x: a + x["tokens"]).alias("n_tokens"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Each window's new turns and loss texts, parsed from its text: ``turns`` (role, newline, text, newline
    of each) and ``loss_text``, both without escapes, ``new_turns``, ``chars``.

    Turns are told apart by the template's marks in the text; only how many of them are repeated comes from ``n_context``."""
    pieces = F.filter(F.split(F.col("text"), r"<\|im_start\|>"), lambda x, k: k > F.col("n_context"))

    def turn(x: Column) -> Column:
        at = F.locate("\n", x)
        body = F.substring(x, at + 1, F.length(x) - at - len(CLOSE) - 1)
        return F.concat(unescape_role(F.substring(x, F.lit(1), at - 1)), F.lit("\n"), unescape(body), F.lit("\n"))

    said = F.transform("loss", lambda s: unescape(F.substring(F.col("text"), s["from"] + 1, s["to"] - s["from"])))
    return formatted.select(
        "conv_id", "window", F.size(pieces).alias("new_turns"),
        F.array_join(F.transform(pieces, turn), "").alias("turns"), F.array_join(said, "").alias("loss_text"), F.length("text").alias("chars"),
    )


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """The row of the contract for each conversation.

    A digest over a whole conversation needs its text in one row; windows are first put
    together by pieces, so that this last step meets few, long strings.
    """

    def put(rows: DataFrame, *keys: str) -> DataFrame:
        order = "window" if "piece" in keys else "piece"
        g = rows.groupBy(*keys).agg(F.sum("new_turns").alias("new_turns"), F.sum("chars").alias("chars"), F.array_sort(F.collect_list(F.struct(order, "turns", "loss_text"))).alias("all"))
        text = lambda c: F.array_join(F.transform("all", lambda x: x[c]), "").alias(c)
        return g.select(*keys, "new_turns", "chars", text("turns"), text("loss_text"))

    parts = put(read_back(formatted).withColumn("piece", F.floor(F.col("window") / PIECE)), "conv_id", "piece")
    whole = put(parts, "conv_id")
    return whole.select(
        "conv_id", F.col("new_turns").cast("bigint").alias("n_turns"), F.sha2(F.col("turns").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"), F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"), F.col("chars").cast("bigint").alias("formatted_chars"),
    )
