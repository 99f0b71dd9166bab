import json
import random

from pyspark.sql import functions as F

from foliomill.functions.text import token_set
from foliomill.operators import chat

SCHEMA = "conv bigint, turn bigint, role string, text string"
COLS = ("conv", "turn", "role", "text")


def talk(spark, n=11):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"m{t}") for t in range(n)]
    rows += [(2, 0, "system", "be kind"), (2, 1, "user", "hi"), (2, 2, "user", "still there?")]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(3), sorted(rows)


def test_pages_and_requests_rebuild_every_history(spark):
    df, rows = talk(spark)
    for page_turns in (2, 3, 100):
        pages = {}
        for r in chat.thread_pages(df, *COLS, page_turns).collect():
            assert r.n_messages == len(r.messages) <= page_turns
            pages.setdefault(r.conv, {})[r.page] = [tuple(m) for m in r.messages]
        for conv in (1, 2):
            whole = [m for p in sorted(pages[conv]) for m in pages[conv][p]]
            assert whole == [(role, text) for c, _, role, text in rows if c == conv]
        requests = chat.request_histories(df, *COLS, page_turns).collect()
        assert len(requests) == sum(role == "user" for _, _, role, _ in rows)
        for r in requests:
            earlier = [m for p in range(r.earlier_pages) for m in pages[r.conv].get(p, [])]
            full = earlier + [tuple(m) for m in r.messages]
            assert full == [(role, text) for c, t, role, text in rows if c == r.conv and t <= r.turn]


def test_last_message(spark):
    df, _ = talk(spark)
    assert {(r.conv, r.text) for r in chat.last_messages(df, "conv", "turn").collect()} == {(1, "m10"), (2, "still there?")}


def test_blank_messages_go(spark):
    df = spark.createDataFrame([("a",), ("",), (" \t\n",), (" ",), (None,)], "text string")
    assert [r.text for r in chat.valid_messages(df).collect()] == ["a"]


def test_system_message_only_when_set(spark):
    df = spark.createDataFrame([("s",), (None,)], "system string")
    user = F.array(F.struct(F.lit("user").alias("role"), F.lit("q").alias("content")))
    got = [[tuple(m) for m in r[0]] for r in df.select(chat.prepend_system(user, F.col("system"))).collect()]
    assert got == [[("system", "s"), ("user", "q")], [("user", "q")]]


def test_pairs_become_two_messages(spark):
    df, _ = talk(spark, 4)
    pairs = chat.answered_turns(df, *COLS)
    got = chat.pairs_to_messages(pairs, ["conv", "turn"], "question", "answer").orderBy("conv", "turn", "position").collect()
    assert [(r.role, r.content) for r in got] == [("user", "m0"), ("assistant", "m1"), ("user", "m2"), ("assistant", "m3")]


def test_replies_in_both_shapes(spark):
    def message(text):
        return {"role": "assistant", "content": text}

    replies = [
        json.dumps({"messages": [message("a"), message("b")]}),
        json.dumps({"choices": [{"message": message("c"), "index": 0}, {"message": message("d")}]}),
        json.dumps({"choices": []}), json.dumps({"error": "x"}), "not json", None,
    ]
    df = spark.createDataFrame(list(enumerate(replies)), "i int, reply string")
    out = chat.normalize_reply(df, "reply")
    got = {r.i: (r.status, [m.content for m in r.messages] if r.messages else None) for r in out.collect()}
    assert got == {0: ("ok", ["a", "b"]), 1: ("ok", ["c"]), **{i: ("rejected", None) for i in (2, 3, 4, 5)}}
    assert chat.require_reply(out.filter("i < 2")).count() == 2
    try:
        chat.require_reply(out).select("messages").collect()
        raise AssertionError("a rejected reply must stop the job")
    except Exception as problem:
        assert "neither messages nor choices" in str(problem)


def test_rendered_sources(spark):
    df = spark.createDataFrame(
        [(1, "a\nb", '[{"doc_name":"d","page_nr":"3"},{"doc_name":"e","page_nr":"0"}]'), (2, "x", ""), (3, "x", None), (4, "x", "[]")],
        "i int, answer string, sources string",
    )
    got = {r.i: r.h for r in df.select("i", chat.render_answer(F.col("answer"), F.col("sources")).alias("h")).collect()}
    head = "<br/><br/><br/><strong>Sources:</strong><br/> <ul>"
    assert got == {1: f"a<br/>b{head}<li>d - Page 3</li>\n<li>e - Page 0</li></ul>", 2: "x", 3: "x", 4: f"x{head}</ul>"}


def test_memory_crosses_threads_but_not_users(spark):
    rows = [(1, 0, "user", "Remember: my name is Bob"), (2, 0, "user", "remember the blue door"), (3, 0, "user", "no keyword")]
    messages = spark.createDataFrame(rows, SCHEMA).withColumn("user", F.when(F.col("conv") == 2, 2).otherwise(1))
    puts = chat.memory_puts(messages, "user", ["conv", "turn"], "remember")
    store = chat.stored_memories(puts.unionByName(puts), ["conv", "turn"])
    assert store.count() == 2
    asked = spark.createDataFrame([(1, "what is my name?"), (2, "which door"), (3, "anything")], "user_id int, query string")
    found = chat.search_memories(store, asked)
    assert {(r.user_id, r.data, r.rank) for r in found.collect()} == {(1, rows[0][3], 1), (2, rows[1][3], 1)}
    context = {r.user_id: r.system_message for r in chat.memory_context(found, "Info: ").collect()}
    assert context == {1: "Info: Remember: my name is Bob", 2: "Info: remember the blue door"}


def test_memory_search_with_one_busy_user(spark):
    rng = random.Random(2)
    words = "red green blue door key lamp".split()
    rows = [(1 if i % 3 else 2, f"k{i:03d}", " ".join(rng.choices(words, k=3))) for i in range(120)]
    memories = spark.createDataFrame(rows, "user_id int, key string, data string").withColumn("namespace", F.lit("memories"))
    asked = spark.createDataFrame([(1, "red door key"), (2, "lamp")], "user_id int, query string")
    expected = set()
    for user, query in ((1, "red door key"), (2, "lamp")):
        want = set(query.split())
        scored = sorted((-round(len(want & set(d.split())) / len(want), 6), k) for u, k, d in rows if u == user)[:10]
        expected |= {(user, k, -s, at + 1) for at, (s, k) in enumerate(scored)}
    got = chat.search_memories(memories, asked).collect()
    assert {(r.user_id, r.key, r.score, r.rank) for r in got} == expected


def test_token_set_is_shared(spark):
    row = spark.createDataFrame([("The the café!",)], "t string").select(token_set(F.col("t"))).first()[0]
    assert row == ["the", "caf"]


def test_histories_are_whole_beyond_a_page(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"m{t}") for t in range(600)] + [(2, 0, "system", "only")]
    messages = spark.createDataFrame(rows, "conv bigint, turn bigint, role string, text string")
    asked = spark.createDataFrame([(1, 590)], "conv bigint, turn bigint")
    pages = sorted(chat.full_histories(messages, asked, "conv", "turn", "role", "text").collect(), key=lambda r: r.page)
    assert [len(r.messages) for r in pages] == [256, 256, 79] and {r.n_messages for r in pages} == {591}
    assert [m.content for r in pages for m in r.messages] == [f"m{t}" for t in range(591)]
    threads = chat.thread_pages(messages.filter("role <> 'system' AND turn > 300"), "conv", "turn", "role", "text")
    system = spark.createDataFrame([(1, "intro"), (2, "only")], "conv bigint, system string")
    opened = {(r.conv, r.page): [m.content for m in r.messages] for r in chat.open_threads(threads, system, "conv").collect()}
    assert opened[1, 1][:2] == ["intro", "m301"] and opened[1, 2][0] == "m512" and opened[2, 0] == ["only"]
