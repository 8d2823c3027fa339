"""Chat formatting by quotation linking, in DataFrame operations only.

Lines that begin with '>' marks are quotations, their level the number of
marks. Runs of lines of one level are passages. Passages are normalised (white
space, case) and hashed; own texts are hashed as wholes, as paragraphs and as
lines, each hash kept once with its earliest message; a join then links each
passage to the message that it quotes, first in its own conversation, else
anywhere. A passage's lines are looked up too, the longest first, after the
whole. Turns say nothing about the order of two conversations, so a message of
another conversation may be quoted whatever its turn.

The conversations are rebuilt in reply order, without quotations and their
attribution lines: after a message come the messages that quote it, each with
what follows from it, and then the message that merely comes next. Messages have
paths for this: a run of messages that only follow each other has the path of
the message that its first one quotes, and each message adds its own place. The
paths of runs are put together by pointer jumping, in rounds that grow with the
logarithm of their nesting.

Places are counted over range partitions, so that no conversation is one group.

Defined results: a null text is an empty message; very long messages are kept
whole; repeated rows are one message; messages of one turn are ordered by role,
then by a hash of them; a passage quoted from nowhere stays unlinked and is removed all the
same; a message without a linked passage answers the message before it (the
first answers none); a null conversation or turn is a value of its own, before
all others; an empty table gives no rows; other columns, whatever their names,
are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigora.llm.common import checkpointed, table

MARKS = r"^ ?>(?: ?>)*"
ATTRIBUTION = r"(?i)^(?:on .+ wrote|am .+ schrieb.*|le .+ a écrit|el .+ escribió) ?: ?$"
#: Messages in one row of the result; longer conversations have several rows (parts), for none is gathered whole.
PART = 256
#: Rounds of pointer jumping: runs nested up to 2 ** ROUNDS deep.
ROUNDS = 40


def _normal(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))


def _hash(c: Column) -> Column:
    return F.unhex(F.md5(c.cast("binary")))


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), "[^>]", ""))


def parse(messages: DataFrame) -> DataFrame:
    """Distinct messages with ``mid``, ``content`` (own text) and ``quotes`` (lines with their levels)."""
    rows = messages.select(F.col("conv_id"), F.col("turn"), F.col("role"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(_level(x).alias("level"), F.regexp_replace(x, MARKS + " ?", "").alias("body")))
    quoted = F.col("text").rlike(r"(?m)" + MARKS)
    own = F.array_join(F.transform(F.filter(F.col("lines"), lambda x: (x.level == 0) & ~x.body.rlike(ATTRIBUTION)), lambda x: x.body), "\n")
    return (
        rows.withColumn("mid", F.unhex(F.md5(F.to_json(F.struct("conv_id", "turn", "role", "text")).cast("binary"))))
        .withColumn("lines", F.when(quoted, lines))
        .withColumn("content", F.when(quoted, F.trim(F.regexp_replace(own, r"\n{3,}", "\n\n"))).otherwise(F.col("text")))
        .drop("text")
    )


def passages(parsed: DataFrame) -> DataFrame:
    """mid, conv_id, turn, passage (number), level, text, keys (hashes to look for: of the whole, then of its lines, the longest first)."""
    order = Window.partitionBy("mid").orderBy("pos")
    lines = parsed.where(F.col("lines").isNotNull()).select("mid", "conv_id", "turn", F.posexplode("lines").alias("pos", "line")).select("mid", "conv_id", "turn", "pos", "line.*")
    runs = lines.withColumn("new", F.coalesce((F.lag("level").over(order) != F.col("level")).cast("int"), F.lit(1))).withColumn("passage", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = (
        runs.where("level > 0").groupBy("mid", "conv_id", "turn", "passage", "level")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "body"))), lambda x: x.body), "\n").alias("text"))
    )
    lines = F.array_sort(F.transform(F.split("text", "\n"), lambda x: F.struct((-F.length(_normal(x))).alias("n"), _normal(x).alias("x"))))
    lines = F.transform(F.filter(lines, lambda x: x.n < 0), lambda x: _hash(x.x))
    return whole.where(F.length(_normal(F.col("text"))) > 0).withColumn("keys", F.array_distinct(F.concat(F.array(_hash(_normal(F.col("text")))), lines)))


def link(parsed: DataFrame) -> DataFrame:
    """mid, passage, level, src_conv, src_turn (null if unlinked)."""
    quotes = passages(parsed)
    wanted = quotes.select("mid", "conv_id", "turn", "passage", "level", F.posexplode("keys").alias("rank", "key"))
    texts = F.array_distinct(F.transform(F.concat(F.array("content"), F.split("content", r"\n\s*\n"), F.split("content", "\n")), _normal))
    # Only hashes that are quoted somewhere matter; each is kept once for all, and once for each conversation.
    originals = (
        parsed.select("conv_id", "turn", F.explode(F.filter(texts, lambda x: F.length(x) > 0)).alias("x")).select("conv_id", "turn", _hash(F.col("x")).alias("key"))
        .groupBy("key", "conv_id").agg(F.min("turn").alias("turn"))
        .join(wanted.select("key").distinct(), "key", "left_semi")
    )
    here = originals.select(F.col("conv_id").alias("h_conv"), F.col("key").alias("h_key"), F.col("turn").alias("h_turn"))
    # The two least conversations of each hash: a message of the first takes the second.
    least = F.min(F.struct("conv_id", "turn"))
    anywhere = originals.groupBy("key").agg(least.alias("any"))
    second = originals.join(anywhere, "key").where(~F.col("conv_id").eqNullSafe(F.col("any.conv_id"))).groupBy("key").agg(least.alias("other"))
    anywhere = anywhere.join(second, "key", "left").withColumn("other", F.coalesce("other", "any"))
    found = (
        wanted.join(here, (F.col("conv_id").eqNullSafe(F.col("h_conv"))) & (F.col("key") == F.col("h_key")) & (F.col("h_turn") < F.col("turn")), "left")
        .join(anywhere, "key", "left").withColumn("any", F.when(F.col("any.conv_id").eqNullSafe(F.col("conv_id")), F.col("other")).otherwise(F.col("any")))
        .withColumn("src", F.when(F.col("h_key").isNotNull(), F.struct(F.lit(0).alias("how"), F.col("rank"), F.col("conv_id").alias("conv"), F.col("h_turn").alias("turn")))
                    .when(F.col("any").isNotNull() & ~F.col("any.conv_id").eqNullSafe(F.col("conv_id")), F.struct(F.lit(1).alias("how"), F.col("rank"), F.col("any.conv_id").alias("conv"), F.col("any.turn").alias("turn"))))
    )
    return found.groupBy("mid", "passage", "level").agg(F.min("src").alias("src")).select("mid", "passage", "level", F.col("src.conv").alias("src_conv"), F.col("src.turn").alias("src_turn"), F.col("src").isNotNull().alias("linked"))


def _dealt(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` in range partitions by conversation and order, with the partition's number as _pid; written, for the ranges are drawn by chance."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return checkpointed(rows.repartitionByRange(n, F.asc_nulls_first("conv_id"), *order).withColumn("_pid", F.spark_partition_id()))


def _carried(dealt: DataFrame, order: list[Column], values: dict[str, Column]) -> DataFrame:
    """``dealt`` with the place of each row in its conversation, and for each of ``values`` the greatest of the rows up to and with this one."""
    inside = Window.partitionBy("_pid", "conv_id").orderBy(*order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    # A row for each conversation and partition: few, however long a conversation is.
    sums = dealt.groupBy(F.col("conv_id").alias("_conv"), F.col("_pid").alias("_at")).agg(F.count("*").alias("_n"), *[F.max(v).alias(f"_m_{k}") for k, v in values.items()])
    before = Window.partitionBy("_conv").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_conv", "_at", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), *[F.max(f"_m_{k}").over(before).alias(f"_b_{k}") for k in values])
    own = dealt.withColumn("_k", F.row_number().over(inside)).withColumns({f"_o_{k}": F.max(v).over(so_far) for k, v in values.items()} or {"_none": F.lit(0)})
    joined = own.join(sums, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("_pid") == F.col("_at")))
    return joined.withColumn("place", F.col("_before") + F.col("_k")).withColumns({k: F.greatest(f"_o_{k}", f"_b_{k}") for k in values} or {"_none": F.lit(0)}).select(*dealt.columns, "place", *values)


def _paths(runs: DataFrame) -> DataFrame:
    """conv_id, run, path: the paths of the runs that begin with a quotation; runs: conv_id, run, up (the run of the quoted message), step."""
    now = checkpointed(runs.select("conv_id", "run", "up", F.array("step", "run").alias("path")))
    for _ in range(ROUNDS):
        if now.where("up IS NOT NULL").isEmpty():
            return now
        above = now.select(F.col("conv_id").alias("_conv"), F.col("run").alias("_run"), F.col("up").alias("_up"), F.col("path").alias("_path"))
        now = checkpointed(
            now.join(above, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("up") == F.col("_run")), "left")
            .select("conv_id", "run", F.col("_up").alias("up"), F.when(F.col("_path").isNotNull(), F.concat("_path", "path")).otherwise(F.col("path")).alias("path"))
        )
    raise RuntimeError("paths did not settle")


def in_reply_order(parsed: DataFrame, replies: DataFrame) -> DataFrame:
    """mid, conv_id, turn, role, replies' columns and place: where each message stands in its conversation; and earlier, the turn before it in turn order. Texts stay behind.

    replies: mid, reply (src_conv, src_turn; null if none), more.
    """
    by_turn = [F.asc_nulls_first("turn"), F.col("role"), F.col("mid")]
    rows = _carried(_dealt(parsed.select("mid", "conv_id", "turn", "role"), by_turn), by_turn, {}).withColumnRenamed("place", "at")
    turns = rows.groupBy("conv_id", "turn").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    turns = checkpointed(turns.select(F.col("conv_id").alias("_conv"), F.col("turn").alias("_turn"), "first", "last"))
    rows = rows.join(replies, "mid", "left").withColumn("_local", F.col("reply.src_conv").eqNullSafe(F.col("conv_id")) & F.col("reply").isNotNull())
    # The message that is answered: the first of the quoted turn, if it comes before.
    rows = rows.join(turns.drop("last"), F.col("_local") & F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("reply.src_turn").eqNullSafe(F.col("_turn")), "left").drop("_conv", "_turn")
    rows = rows.withColumn("answers", F.when(F.col("first") < F.col("at"), F.col("first"))).drop("first", "_local")
    # The turn of the message before: that of the same turn, if it is not the first there, else the turn that ends there.
    ends = turns.select(F.col("_conv"), (F.col("last") + 1).alias("_next"), F.col("_turn").alias("_before"))
    begins = turns.select(F.col("_conv").alias("_c"), F.col("_turn").alias("_t"), F.col("first").alias("_first"))
    rows = (
        rows.join(ends, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("at") == F.col("_next")), "left")
        .join(begins, F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("turn").eqNullSafe(F.col("_t")))
        .withColumn("earlier", F.when(F.col("at") == F.col("_first"), F.col("_before")).otherwise(F.col("turn"))).drop("_conv", "_next", "_before", "_c", "_t", "_first")
    )
    # A run begins where a message answers another than the one before it.
    begins = F.when((F.col("at") == 1) | (F.col("answers") < F.col("at") - 1), F.col("at"))
    by_place = [F.col("at")]
    rows = checkpointed(_carried(_dealt(rows, by_place), by_place, {"run": begins}).drop("place", "_pid"))
    heads = rows.where((F.col("run") == F.col("at")) & F.col("answers").isNotNull()).select("conv_id", "run", "answers")
    # Quotations of a message whose next message quotes it too come after that one's run, the last quoted message first.
    target = rows.select(F.col("conv_id").alias("_conv"), F.col("at").alias("_at"), F.col("run").alias("up"))
    after = rows.where(F.col("answers") == F.col("at") - 1).select(F.col("conv_id").alias("_c"), F.col("answers").alias("_a"))
    runs = (
        heads.join(target, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("answers") == F.col("_at")))
        .join(after, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("answers") == F.col("_a")), "left")
        .select("conv_id", "run", "up", F.when(F.col("_a").isNull(), F.col("answers")).otherwise(F.lit(1 << 62) - F.col("answers")).alias("step"))
    )
    paths = _paths(runs).select(F.col("conv_id").alias("_conv"), F.col("run").alias("_run"), "path")
    rows = rows.join(paths, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("run") == F.col("_run")), "left")
    rows = rows.withColumn("path", F.concat(F.coalesce("path", F.array().cast("array<bigint>")), F.array("at"))).drop("_conv", "_run", "run")
    by_path = [F.col("path")]
    return _carried(_dealt(rows, by_path), by_path, {}).drop("path", "_pid")


def conversations(messages: DataFrame, part: int = PART) -> DataFrame:
    """conv_id, part, n_messages, n_quotes, n_linked, messages (position, turn, role, content, reply_conv, reply_turn), in reply order."""
    parsed = parse(messages)
    links = link(parsed)
    first = links.groupBy("mid").agg(F.count("*").alias("n_quotes"), F.sum(F.col("linked").cast("int")).alias("n_linked"), F.min(F.when(F.col("linked"), F.struct("level", "passage", "src_conv", "src_turn"))).alias("reply"))
    placed = in_reply_order(parsed, checkpointed(first)).join(parsed.select("mid", "content"), "mid")
    message = F.struct(
        F.col("place").alias("position"), "turn", "role", "content",
        F.when(F.col("reply").isNotNull(), F.col("reply.src_conv")).when(F.col("at") > 1, F.col("conv_id")).alias("reply_conv"),
        F.when(F.col("reply").isNotNull(), F.col("reply.src_turn")).when(F.col("at") > 1, F.col("earlier")).alias("reply_turn"),
    )
    return (
        placed.withColumn("part", F.floor((F.col("place") - 1) / part))
        .groupBy("conv_id", "part")
        .agg(F.count("*").alias("n_messages"), F.sum(F.coalesce("n_quotes", F.lit(0))).alias("n_quotes"), F.sum(F.coalesce("n_linked", F.lit(0))).alias("n_linked"), F.array_sort(F.collect_list(message)).alias("messages"))
    )


def op4_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations(table(spark, sf_dir, "conversations"))
