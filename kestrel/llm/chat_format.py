"""Chat formatting into budgeted windows, with DataFrame operations only.

Turns are priced in tokens (words and signs, plus a fixed price for their markers). Prefix sums of
these prices, counted from the first turn after the system turn, cut a conversation at the
multiples of its body size: turns that lie inside one stretch form a span, a turn that crosses a
boundary is a span of its own. So spans begin and end with whole turns, hold at most the body
size (a single longer turn stands alone), and no span depends on where an earlier one ended.
A window is the system turn, as much of the turns before the span as HISTORY tokens hold, and the
span. The loss mask covers the texts of the span's assistant turns; repeated turns are context
only, so that every target is trained on once.

Prefix sums are taken in runs of CHUNK turns first and then over the runs, and windows are built
per (conversation, stretch), so one very long conversation is spread over many tasks.

Template: a start marker, the role, a line break, the text, an end marker, a line break. Control strings inside
roles and texts, and backslashes, are escaped with a backslash; ``unescape`` restores them.

Defined results: null role or text is empty; turns are ordered by turn (null first), role, text,
so ties and repeated rows have a fixed order and all stay; null conv_id is a conversation of its
own; a system turn that comes first is retained in each window, unless it is all there is;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BUDGET = 2048     # tokens of a window
HISTORY = 512     # of them for repeated turns
LEAST_BODY = 256  # a span's size where the system turn leaves less
MARKERS = 4       # tokens charged for a turn's markers
CHUNK = 256       # turns summed together before the runs are

START, STOP = "<|im_start|>", "<|im_end|>"

#: Strings with a meaning to chat templates and tokenizers; inside a text they are escaped.
CONTROL = (
    "<|im_start|>", "<|im_end|>", "<|im_sep|>", "<|startoftext|>", "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<|end|>",
    "<|eot_id|>", "<|begin_of_text|>", "<|end_of_text|>", "<|start_header_id|>", "<|end_header_id|>",
    "<s>", "</s>", "<unk>", "<pad>", "<bos>", "<eos>", "<start_of_turn>", "<end_of_turn>",
    "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
)


def escape(col: Column, lines: bool = False) -> Column:
    """Reversibly remove control strings (and with ``lines`` line breaks): each backslash gets an
    `e` behind it, the first character of a control string becomes a backslash and a letter."""
    col = F.replace(col, F.lit("\\"), F.lit("\\e"))
    for word in CONTROL:
        col = F.replace(col, F.lit(word), F.lit({"<": "\\l", "[": "\\b"}[word[0]] + word[1:]))
    return F.replace(col, F.lit("\n"), F.lit("\\n")) if lines else col


def unescape(col: Column) -> Column:
    for code, char in (("\\l", "<"), ("\\b", "["), ("\\n", "\n"), ("\\e", "\\")):
        col = F.replace(col, F.lit(code), F.lit(char))
    return col


def price(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\w+|[^\w\s]")).cast("bigint") + MARKERS


def placed_turns(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Every turn with its place from 1, its tokens, and the tokens up to its end (``upto``), within
    its conversation, and the conversation's number of turns."""
    base = turns.select(F.col(conv).alias("conv"), F.col(turn).cast("bigint").alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    base = base.withColumn("tokens", price(F.col("text"))).withColumn("chunk", F.floor(F.col("turn") / CHUNK))
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    inner = Window.partitionBy("conv", "chunk").orderBy(*order)
    local = base.withColumn("place", F.row_number().over(inner).cast("bigint")).withColumn("upto", F.sum("tokens").over(inner.rowsBetween(Window.unboundedPreceding, 0)))
    runs = base.groupBy("conv", "chunk").agg(F.count("*").alias("n"), F.sum("tokens").alias("sum"))
    outer = Window.partitionBy("conv").orderBy(F.col("chunk").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    runs = (runs.withColumn("n_before", F.coalesce(F.sum("n").over(outer), F.lit(0))).withColumn("sum_before", F.coalesce(F.sum("sum").over(outer), F.lit(0)))
            .withColumn("n_turns", F.sum("n").over(Window.partitionBy("conv"))))
    joined = local.alias("t").join(runs.alias("r"), F.expr("t.conv <=> r.conv and t.chunk <=> r.chunk"))
    return joined.select("t.conv", "t.role", "t.text", "t.tokens", (F.col("t.place") + F.col("r.n_before")).alias("place"),
                         (F.col("t.upto") + F.col("r.sum_before")).alias("upto"), "r.n_turns")


def windows(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
            budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per window: conv, first (place of its first target turn), n_system, n_history,
    n_targets, formatted, loss_spans (start and length in code points of ``formatted``)."""
    placed = placed_turns(turns, conv, turn, role, text)
    rendered = (placed.withColumn("head", F.concat(F.lit(START), escape(F.col("role"), lines=True), F.lit("\n"))).withColumn("body", escape(F.col("text")))
                .select("conv", "role", "place", "tokens", "upto", F.concat("head", "body", F.lit(STOP + "\n")).alias("shown"),
                        F.length("head").alias("skip"), F.length("body").alias("size"),
                        ((F.col("place") == 1) & (F.col("role") == "system") & (F.col("n_turns") > 1)).alias("is_system")))
    system = rendered.filter("is_system").select("conv", F.col("tokens").alias("system_tokens"), F.col("shown").alias("system"))
    joined = (rendered.filter("not is_system").alias("t").join(system.alias("s"), F.expr("t.conv <=> s.conv"), "left")
              .select("t.conv", "t.role", "t.place", "t.shown", "t.skip", "t.size", "t.tokens", "s.system",
                      (F.col("t.upto") - F.coalesce("s.system_tokens", F.lit(0))).alias("end"),
                      F.greatest(F.lit(budget - history) - F.coalesce("s.system_tokens", F.lit(0)), F.lit(LEAST_BODY)).alias("stretch")))
    spans = (joined.withColumn("begin", F.col("end") - F.col("tokens")).withColumn("home", F.floor(F.col("begin") / F.col("stretch")))
             .withColumn("crosses", F.floor((F.col("end") - 1) / F.col("stretch")) > F.col("home")))
    turn_of = F.struct("place", "begin", "end", "role", "shown", "skip", "size", "crosses")
    targets = spans.select("conv", "home", "system", turn_of.alias("target"), F.lit(None).cast(spans.select(turn_of.alias("x")).schema["x"].dataType).alias("before"))
    # a turn may be repeated by spans that begin between its end and HISTORY tokens after its beginning
    copies = (spans.filter(F.col("tokens") <= history)
              .withColumn("home", F.explode(F.sequence(F.floor(F.col("end") / F.col("stretch")), F.floor((F.col("begin") + history) / F.col("stretch")))))
              .select("conv", "home", "system", F.lit(None).cast(targets.schema["target"].dataType).alias("target"), turn_of.alias("before")))
    # a group holds the turns of one stretch and HISTORY tokens before it: its size has a bound
    grouped = (targets.unionByName(copies).groupBy("conv", "home", "system")
               .agg(F.array_sort(F.collect_list("target")).alias("targets"), F.array_sort(F.collect_list("before")).alias("before")))
    two = grouped.select("conv", "system", "before", F.explode(F.array(F.filter("targets", lambda t: ~t["crosses"]), F.filter("targets", lambda t: t["crosses"]))).alias("targets"))
    chosen = (two.filter(F.size("targets") > 0).withColumn("from", F.element_at("targets", 1)["begin"])
              .withColumn("before", F.expr(f"filter(before, t -> t.end <= `from` and t.begin >= `from` - {history})")))
    context = F.concat(F.coalesce("system", F.lit("")), F.array_join(F.transform("before", lambda t: t["shown"]), ""))
    spans_of = F.expr("""aggregate(targets, named_struct('at', length(context), 'spans', cast(array() as array<struct<start:int,length:int>>)),
        (s, t) -> named_struct('at', s.at + length(t.shown),
                               'spans', if(t.role = 'assistant', concat(s.spans, array(named_struct('start', s.at + t.skip, 'length', t.size))), s.spans)),
        s -> s.spans)""")
    return (chosen.withColumn("context", context).select(
        "conv", F.element_at("targets", 1)["place"].alias("first"), F.col("system").isNotNull().cast("int").alias("n_system"),
        F.size("before").alias("n_history"), F.size("targets").alias("n_targets"),
        F.concat("context", F.array_join(F.transform("targets", lambda t: t["shown"]), "")).alias("formatted"), spans_of.alias("loss_spans")))


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from its windows alone: conv, n_turns, all turns as `role \\n text \\n`, all
    text under the loss mask, and the windows' characters. Whole conversations come together here:
    this is for digests and checks."""
    turns = F.slice(F.split("formatted", r"<\|im_end\|>\n"), 1, F.col("n_system") + F.col("n_history") + F.col("n_targets"))
    own = F.expr("""filter(turns, (t, i) -> i >= n_system + n_history or (opening and i < n_system))""")
    def shown(part):
        line = F.substr(part, F.lit(len(START) + 1))
        role = F.substring_index(line, "\n", 1)
        return F.concat(unescape(role), F.lit("\n"), unescape(F.substr(line, F.length(role) + 2)), F.lit("\n"))
    rows = (formatted.withColumn("turns", turns)
            # the system turn counts in the window that begins with the turn after it
            .withColumn("opening", F.col("first") == F.col("n_system") + 1).withColumn("own", own)
            .select("conv", F.struct("first", F.size("own").alias("n"), F.array_join(F.transform("own", shown), "").alias("said"),
                                     F.array_join(F.transform("loss_spans", lambda s: unescape(F.substr("formatted", s["start"] + 1, s["length"]))), "").alias("loss"),
                                     F.length("formatted").alias("chars")).alias("w")))
    whole = rows.groupBy("conv").agg(F.array_sort(F.collect_list("w")).alias("w"))
    return whole.select("conv", F.expr("aggregate(w, 0L, (s, x) -> s + x.n)").alias("n_turns"), F.array_join(F.transform("w", lambda x: x["said"]), "").alias("said"),
                        F.array_join(F.transform("w", lambda x: x["loss"]), "").alias("loss"), F.expr("aggregate(w, 0L, (s, x) -> s + x.chars)").alias("formatted_chars"))
