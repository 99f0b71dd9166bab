"""Conversations as tables: message arrays, histories, reply parsing, source lists and long-term memory.

A message array is stored in pages of ``PAGE_TURNS`` turns. One conversation may own any share of the messages;
its pages are bounded all the same, and a thread is its pages in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliomill.functions.text import is_blank, token_set
from foliomill.operators.keyed import newest_per_key

PAGE_TURNS = 256
MEMORY_LIMIT = 10
MESSAGE = "struct<role:string,content:string>"

# The markup of a rendered source list.
SOURCES_OPEN = "<br/><br/><br/><strong>Sources:</strong><br/> <ul>"
SOURCES_CLOSE = "</ul>"


def valid_messages(messages: DataFrame, text: str = "text") -> DataFrame:
    return messages.filter(~is_blank(F.col(text)))


def keyword_messages(messages: DataFrame, keyword: str, text: str = "text") -> DataFrame:
    return messages.filter(F.lower(F.col(text)).contains(keyword.lower()))


def _message(role: Column | str, text: Column | str) -> Column:
    role = F.col(role) if isinstance(role, str) else role
    text = F.col(text) if isinstance(text, str) else text
    return F.struct(role.alias("role"), text.alias("content"))


def _page(turn: str, page_turns: int) -> Column:
    return F.floor(F.col(turn) / page_turns).cast("bigint")


def thread_pages(messages: DataFrame, thread: str, turn: str, role: str, text: str, page_turns: int = PAGE_TURNS) -> DataFrame:
    """``thread, page, n_messages, messages``: the ordered messages of a conversation, page by page."""
    in_order = F.sort_array(F.collect_list(F.struct(F.col(turn).alias("turn"), _message(role, text).alias("m"))))
    return (
        messages.groupBy(thread, _page(turn, page_turns).alias("page"))
        .agg(in_order.alias("_all"))
        .select(
            thread,
            "page",
            F.size("_all").cast("bigint").alias("n_messages"),
            F.transform("_all", lambda e: e["m"]).alias("messages"),
        )
    )


def request_histories(
    messages: DataFrame, thread: str, turn: str, role: str, text: str, page_turns: int = PAGE_TURNS
) -> DataFrame:
    """One request per user turn with its history: ``thread, turn, earlier_pages, messages``.

    ``messages`` holds the turns of the request's own page up to the request; the ``earlier_pages`` full pages of
    :func:`thread_pages` come before it. Up to ``page_turns`` turns that is the whole history in one array, and a
    longer conversation still costs space in proportion to its length.
    """
    so_far = Window.partitionBy(thread, "_page").orderBy(turn).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        messages.withColumn("_page", _page(turn, page_turns))
        .withColumn("messages", F.collect_list(_message(role, text)).over(so_far))
        .filter(F.col(role) == "user")
        .select(thread, turn, F.col("_page").alias("earlier_pages"), "messages")
    )


def full_histories(
    messages: DataFrame, requests: DataFrame, thread: str, turn: str, role: str, text: str, page_turns: int = PAGE_TURNS
) -> DataFrame:
    """Whole history of chosen requests, one per thread: ``thread, turn, page, n_messages, messages``.

    One row per page of the thread up to the request, in order by ``page``; ``n_messages`` counts the whole history. Each
    row is bounded, however long the thread.
    """
    chosen = requests.select(thread, F.col(turn).alias("_request"))
    before = messages.join(chosen, thread).filter(F.col(turn) <= F.col("_request"))
    in_order = F.sort_array(F.collect_list(F.struct(F.col(turn).alias("turn"), _message(role, text).alias("m"))))
    pages = before.groupBy(thread, "_request", _page(turn, page_turns).alias("page")).agg(in_order.alias("_all"))
    total = before.groupBy(thread).agg(F.count(F.lit(1)).alias("n_messages"))
    return pages.join(total, thread).select(
        thread, F.col("_request").alias(turn), "page", "n_messages", F.transform("_all", lambda e: e["m"]).alias("messages")
    )


def open_threads(pages: DataFrame, system: DataFrame, thread: str) -> DataFrame:
    """Put each thread's ``system`` message in front of its first page; a thread with nothing else gets a page of its own."""
    first = pages.groupBy(thread).agg(F.min("page").alias("page"))
    placed = system.join(first, thread, "left").select(thread, F.coalesce("page", F.lit(0)).alias("page"), "system")
    both = pages.join(placed, [thread, "page"], "full_outer")
    none = F.array().cast(f"array<{MESSAGE}>")
    return both.select(thread, "page", prepend_system(F.coalesce("messages", none), F.col("system")).alias("messages"))


def last_messages(messages: DataFrame, thread: str, turn: str) -> DataFrame:
    """The last message of every conversation."""
    return newest_per_key(messages, [thread], [turn])


def last_of(messages: Column) -> Column:
    return F.element_at(messages, -1)


def prepend_system(messages: Column, system: Column) -> Column:
    """Put a system message in front when there is one."""
    first = F.array(_message(F.lit("system"), system))
    return F.when(system.isNotNull(), F.concat(first, messages)).otherwise(messages)


def answered_turns(messages: DataFrame, thread: str, turn: str, role: str, text: str) -> DataFrame:
    """User turns joined to the assistant turn right after them: ``thread, turn, question, answer``."""
    asked = messages.filter(F.col(role) == "user").select(thread, turn, F.col(text).alias("question"))
    replied = messages.filter(F.col(role) == "assistant").select(
        thread, (F.col(turn) - 1).alias(turn), F.col(text).alias("answer")
    )
    return asked.join(replied, [thread, turn])


def pairs_to_messages(pairs: DataFrame, keys: Sequence[str], question: str, answer: str) -> DataFrame:
    """Two message rows per (user, assistant) pair."""
    both = F.array(_message(F.lit("user"), question), _message(F.lit("assistant"), answer))
    return pairs.select(*keys, F.posexplode(both).alias("position", "message")).select(
        *keys, "position", "message.role", "message.content"
    )


def normalize_reply(df: DataFrame, reply: str) -> DataFrame:
    """Parse a model reply in either accepted shape: add ``messages`` and ``status`` (``ok`` or ``rejected``)."""
    shape = f"struct<messages:array<{MESSAGE}>,choices:array<struct<message:{MESSAGE}>>>"
    read = df.withColumn("_reply", F.from_json(F.col(reply), shape))
    first_choice = F.get(F.col("_reply.choices"), F.lit(0))["message"]
    messages = F.coalesce("_reply.messages", F.when(first_choice.isNotNull(), F.array(first_choice)))
    return (
        read.withColumn("messages", messages)
        .withColumn("status", F.when(F.col("messages").isNull(), "rejected").otherwise("ok"))
        .drop("_reply")
    )


def require_reply(df: DataFrame) -> DataFrame:
    """Let a rejected reply stop the job."""
    problem = F.raise_error(F.lit("reply has neither messages nor choices")).cast(f"array<{MESSAGE}>")
    return df.withColumn("messages", F.coalesce("messages", problem))


def render_answer(answer: Column, sources: Column) -> Column:
    """Answer with line breaks and its source list as markup. ``sources`` is JSON text of ``doc_name, page_nr``."""
    listed = F.from_json(sources, "array<struct<doc_name:string,page_nr:string>>")
    items = F.transform(
        listed, lambda s: F.concat(F.lit("<li>"), s["doc_name"], F.lit(" - Page "), s["page_nr"], F.lit("</li>"))
    )
    block = F.concat(F.lit(SOURCES_OPEN), F.array_join(items, "\n"), F.lit(SOURCES_CLOSE))
    missing = F.coalesce(sources, F.lit("")) == ""
    return F.concat(F.regexp_replace(answer, "\n", "<br/>"), F.when(missing, "").otherwise(block))


def memory_puts(messages: DataFrame, user: str, keys: Sequence[str], keyword: str, text: str = "text") -> DataFrame:
    """Memory entries for messages that carry the keyword: ``namespace, user_id, key, data``."""
    key = F.md5(F.concat_ws("#", *[F.col(k).cast("string") for k in keys]))
    return keyword_messages(messages, keyword, text).select(
        F.lit("memories").alias("namespace"), F.col(user).alias("user_id"), key.alias("key"), F.col(text).alias("data"), *keys
    )


def stored_memories(puts: DataFrame, order: Sequence[str]) -> DataFrame:
    """Store after all puts: the newest value per namespace, user and key."""
    return newest_per_key(puts, ["namespace", "user_id", "key"], order)


def search_memories(
    memories: DataFrame,
    queries: DataFrame,
    limit: int = MEMORY_LIMIT,
    namespace: str = "memories",
) -> DataFrame:
    """Best memories of each user for the user's one query: ``user_id, key, data, score, rank``.

    The score is the share of query tokens a memory contains. Each user has one query row, so the memories of a busy
    user can be dealt out over several tasks of the join at run time.
    """
    kept = memories.filter(F.col("namespace") == namespace)
    kept = kept.select("user_id", "key", "data", token_set(F.col("data")).alias("_m"))
    asked = queries.select("user_id", token_set(F.col("query")).alias("_q"))
    score = F.when(F.size("_q") > 0, F.round(F.size(F.array_intersect("_q", "_m")) / F.size("_q"), 6)).otherwise(0.0)
    best = Window.partitionBy("user_id").orderBy(F.col("score").desc(), "key")
    return (
        kept.join(asked, "user_id")
        .select("user_id", "key", "data", score.alias("score"))
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= limit)
    )


def memory_context(found: DataFrame, intro: str) -> DataFrame:
    """System message per user from the memories found: at most the search limit per user."""
    ordered = F.sort_array(F.collect_list(F.struct("rank", "data")))
    info = F.array_join(F.transform(ordered, lambda m: m["data"]), "\n")
    return found.groupBy("user_id").agg(F.concat(F.lit(intro), info).alias("system_message"))
