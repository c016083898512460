"""Folding events into sessions.

A session is one row of constant size, whatever its length; its texts and lists stay in rows of their
own, keyed by session and position. Everything in a session row is a constant-size aggregate: counts, any, and
first/last by order. A session that holds a third of all events is therefore reduced in every
map task before the shuffle. The six command flags are defined on the session's joined command
text; they are computed from single commands all the same (see `_flag_aggregates`), so no text
is collected for them.
"""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardlog import schema as S
from wardlog.functions import (
    joined_text, level_name, matches, number_or_zero, split_commands, text_or_empty, threat_code,
    threat_score,
)
from wardlog.operators.events import valid
from wardlog.session import join_side, materialize

PART_ROWS = 100_000  # commands of one special session that are joined at a time,
PART_CHARS = 16_000_000  # and the characters of their texts


def _is(event_id):
    return F.col("eventid").eqNullSafe(event_id)


def _flag_aggregates() -> dict:
    """Flags of the joined text out of single commands.

    No pattern can match across the separator except through its final white space: a command
    that ends in a tail word and is not the last command of its session. "Not the last" is
    min(order of such commands) < max(order of all commands).
    """
    command, text = _is(S.EVENT_COMMAND), text_or_empty("input")
    out = {}
    for name in S.PATTERNS:
        flag = F.coalesce(F.bool_or(command & matches(text, name)), F.lit(False))
        if name in S.TAIL_WORDS:
            tail = F.min(F.when(command & text.endswith(S.TAIL_WORDS[name]), F.col("ord")))
            last = F.max(F.when(command, F.col("ord")))
            flag = flag | F.coalesce(tail < last, F.lit(False))
        out[name] = flag.cast("int")
    return out


def session_aggregates(events: DataFrame) -> list:
    """Aggregate expressions of one session of these events; they also serve the streaming query.

    Numbers and texts never share an aggregate, which keeps pruning intact: a profile that needs
    only numbers runs as a hash aggregate, because the text buffers disappear from the plan.
    """
    login_ok, login_failed = _is(S.EVENT_LOGIN_SUCCESS), _is(S.EVENT_LOGIN_FAILED)
    command, closed = _is(S.EVENT_COMMAND), _is(S.EVENT_CLOSED)
    order = F.col("ord")
    from_start = F.col("first_ord") if "first_ord" in events.columns else order

    def first(name):
        return F.coalesce(F.min_by(text_or_empty(name), from_start), F.lit(""))

    def last(value, condition):
        return F.max_by(value, F.when(condition, order))

    # Fields that are used together share one aggregate; equal expressions are evaluated once.
    client = F.min_by(F.struct(*[text_or_empty(n).alias(n) for n in ("version", "hassh", "hasshAlgorithms")]), from_start)
    login = last(F.struct(*[text_or_empty(n).alias(n) for n in ("username", "password")]), login_ok)
    return [
        first("src_ip").alias("src_ip"),
        first("timestamp").alias("start_time"),
        last(text_or_empty("timestamp"), closed).alias("end_time"),
        F.coalesce(last(number_or_zero("duration"), closed), F.lit(0.0)).alias("duration"),
        F.coalesce(F.bool_or(login_ok), F.lit(False)).alias("login_success"),
        login["username"].alias("username"),
        login["password"].alias("password"),
        F.coalesce(client["version"], F.lit("")).alias("client_version"),
        F.coalesce(client["hassh"], F.lit("")).alias("hassh"),
        F.coalesce(client["hasshAlgorithms"], F.lit("")).alias("hassh_algorithms"),
        F.count_if(login_ok | login_failed).alias("login_attempt_count"),
        F.count_if(command).alias("command_count"),
        F.count(F.lit(1)).alias("event_count"),
        *[flag.alias(name) for name, flag in _flag_aggregates().items()],
        (
            (F.count_if(command) > 1)
            | F.coalesce(F.bool_or(command & (text_or_empty("input") != "")), F.lit(False))
        ).alias("has_command_text"),
    ]


def with_threat(sessions: DataFrame) -> DataFrame:
    """Adds score, level and level code."""
    scored = sessions.withColumn("threat_score", threat_score())
    code = threat_code(F.col("threat_score"))
    return scored.withColumn("threat_level", level_name(code)).withColumn("threat_code", code)


def sessionize(events: DataFrame, per_file=False) -> DataFrame:
    """One row per session.

    `per_file=True` keeps, for a session seen in several files, only what the greatest file
    holds; the default merges all files.
    """
    if not per_file:
        grouped = valid(events).groupBy(F.col("session").alias("session_id"))
        return grouped.agg(*session_aggregates(events))
    grouped = valid(events).groupBy(F.col("session").alias("session_id"), "file")
    return keep_last_file(grouped.agg(*session_aggregates(events)))


def keep_last_file(partial: DataFrame) -> DataFrame:
    columns = [c for c in partial.columns if c not in ("session_id", "file")]
    last = F.max_by(F.struct(*columns), F.col("file")).alias("kept")
    return partial.groupBy("session_id").agg(last).select("session_id", "kept.*")


def session_features(events: DataFrame, per_file=False) -> DataFrame:
    """One row per session with flags, score and level."""
    return with_threat(sessionize(events, per_file))


def session_entries(events: DataFrame) -> DataFrame:
    """The lists of a session, one row per entry: its commands and its login attempts, keyed by session and
    position. Entries are ordered by position; the length of a list is a count."""
    login = _is(S.EVENT_LOGIN_SUCCESS) | _is(S.EVENT_LOGIN_FAILED)
    listed = valid(events).where(login | _is(S.EVENT_COMMAND))
    return listed.select(
        F.col("session").alias("session_id"), F.when(login, "login_attempts").otherwise("commands").alias("list"),
        F.col("ord").alias("position"), text_or_empty("timestamp").alias("timestamp"),
        F.when(~login, text_or_empty("input")).alias("input"),
        *[F.when(login, text_or_empty(n)).alias(n) for n in ("username", "password")],
        F.when(login, _is(S.EVENT_LOGIN_SUCCESS)).alias("success"),
    )


def commands(events: DataFrame) -> DataFrame:
    """One row per command, exactly as typed; the key is (session_id, position)."""
    return valid(events).where(_is(S.EVENT_COMMAND)).select(
        F.col("session").alias("session_id"), F.col("ord").alias("position"), text_or_empty("timestamp").alias("timestamp"),
        text_or_empty("input").alias("input"),
    )


def joined_commands(events: DataFrame) -> DataFrame:
    """The joined command text of every session in pieces, one per command: (session_id, position, piece).

    Put together in order of position they are the text; every piece but the first begins with the
    separator. The grain is the same for a session of two commands and of a billion.
    """
    typed = commands(events)
    first = typed.groupBy("session_id").agg(F.min("position").alias("first"))
    separator = F.when(F.col("position") == F.col("first"), "").otherwise(S.COMMAND_SEPARATOR)
    return typed.join(first, "session_id").select("session_id", "position", F.concat(separator, "input").alias("piece"))


def _long_sessions(typed: DataFrame, limit, chars) -> DataFrame:
    """Sessions of more than `limit` commands or `chars` characters, with the commands a part may hold.

    Even a part of the session's longest commands stays within `chars`, unless one alone exceeds it.
    """
    size = F.length(text_or_empty("input"))
    sizes = typed.groupBy("session").agg(
        F.count(F.lit(1)).alias("n"), F.sum(size).alias("total"), F.max(size).alias("longest")
    )
    rows = F.greatest(F.lit(1), F.least(F.lit(limit), F.floor(F.lit(chars) / F.greatest(F.col("longest"), F.lit(1)))))
    return sizes.where((F.col("n") > limit) | (F.col("total") > chars)).select("session", rows.alias("part_rows"))


def _cut_long_sessions(typed: DataFrame, long: DataFrame) -> DataFrame:
    """Commands of the long sessions with `part`: at most `part_rows` of a session share one.

    The rows are sorted across all tasks, so a session may span many of them, and written once
    with increasing row numbers, so the numbers are the same in every later use.
    """
    rows = (
        typed.join(long, "session")
        .repartitionByRange("session", "ord").sortWithinPartitions("session", "ord")
        .withColumn("row_number", F.monotonically_increasing_id())
    )
    part = F.floor(F.col("row_number") / F.col("part_rows")).cast("bigint") + 1
    return materialize(rows).withColumn("part", part).drop("row_number", "part_rows")


def _text_parts(typed: DataFrame, limit, chars) -> DataFrame:
    """Joined text of whole sessions, part 0, and of parts above 0 of the long ones: (session_id, part, commands).

    Only `command_tokens` uses this, whose tokens do not depend on where the parts are cut.
    """
    typed = typed.select("session", "ord", "input")
    long = materialize(_long_sessions(typed, limit, chars))
    found = not long.isEmpty()
    whole = F.lit(0).cast("bigint")
    if not found:
        numbered = typed.withColumn("part", whole)
    else:
        long = join_side(long)
        numbered = typed.join(long, "session", "left_anti").withColumn("part", whole).unionByName(
            _cut_long_sessions(typed, long)
        )
    entries = F.array_sort(F.collect_list(F.struct(F.col("ord"), text_or_empty("input").alias("input"))))
    grouped = numbered.groupBy(F.col("session").alias("session_id"), "part").agg(entries.alias("entries"))
    return grouped.select("session_id", "part", joined_text(F.col("entries")).alias("commands"))


def command_tokens(events: DataFrame, limit=PART_ROWS, chars=PART_CHARS) -> DataFrame:
    """Tokens of the joined text of each session, one row per token.

    Splitting the joined text equals splitting each command, except in two kinds of session:
    one with an empty command (a text that is empty as a whole has no tokens), and one with a
    command that ends in a space and a pipe sign (the cut moves). Only those are joined first.
    """
    typed = valid(events).where(_is(S.EVENT_COMMAND))
    text = text_or_empty("input")
    special = materialize(typed.where((text == "") | text.endswith(" |")).select("session").distinct())
    found = not special.isEmpty()
    special = join_side(special)
    split = typed.join(special, "session", "left_anti") if found else typed
    plain = split.select(F.col("session").alias("session_id"), F.explode(split_commands(text)).alias("command"))
    if not found:
        return plain
    joined = _text_parts(typed.join(special, "session", "left_semi"), limit, chars)
    whole_and_empty = (F.col("part") == 0) & (F.col("commands") == "")
    return plain.unionByName(_with_open_ends(joined.where(~whole_and_empty)).select(
        "session_id", F.explode(split_commands(F.col("commands"))).alias("command")
    ))


def _with_open_ends(parts: DataFrame) -> DataFrame:
    """Part texts changed so that splitting them gives the pieces of the whole session's text.

    A part is open when its last piece ends in a space and a pipe sign: with the first space of
    the separator that follows, these form a separator, and the next part begins with what is
    left of it, "| ". Whether a part is open can depend on whether the part before it was. That
    dependence is one of four: never open, always open, the same, the opposite. So the state
    before a part is that of the last part with a fixed state, flipped once per opposite since.
    """
    def is_open(text):
        return F.element_at(split_commands(text), -1).endswith(" |")

    after_closed, after_open = is_open(F.col("commands")), is_open(F.concat(F.lit("| "), "commands"))
    states = parts.withColumns({
        "fixed": F.when(after_closed == after_open, after_closed),
        "flips": F.when(after_closed & ~after_open, 1).otherwise(0),
    })
    # One row per `limit` events: these windows are that much smaller than the session.
    order = W.partitionBy("session_id").orderBy("part")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    states = states.withColumns({
        "last_fixed": F.coalesce(F.last("fixed", ignorenulls=True).over(before), F.lit(False)),
        "run": F.count("fixed").over(before),
    })
    # Parts up to the next fixed one share a run; the fixed part that starts it does not flip.
    in_run = W.partitionBy("session_id", "run").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    flipped = F.coalesce(F.sum("flips").over(in_run), F.lit(0)) % 2 == 1
    states = states.withColumn("opened", F.col("last_fixed") != flipped)
    states = states.withColumn("open", F.coalesce(F.lead("opened").over(order), F.lit(False)))
    whole = states.withColumn("text", F.concat(F.when(F.col("opened"), "| ").otherwise(""), "commands"))
    closed = F.when(F.col("open"), F.expr("left(text, length(text) - 2)")).otherwise(F.col("text"))
    return whole.select("session_id", "part", closed.alias("commands"))


def training_table(sessions: DataFrame, tokens: DataFrame | None = None) -> DataFrame:
    """Sessions with the names that training uses.

    `download_attempts` is the download flag. `unique_commands` is the number of different
    tokens; without a token table it is absent and training fills it with 0.
    """
    out = sessions.withColumns({
        "login_attempts": F.col("login_attempt_count"),
        "download_attempts": F.col("has_download_command"),
    })
    if tokens is None:
        return out
    unique = tokens.distinct().groupBy("session_id").agg(F.count(F.lit(1)).alias("unique_commands"))
    return out.join(unique, "session_id", "left").withColumn(
        "unique_commands", F.coalesce("unique_commands", F.lit(0))
    )
