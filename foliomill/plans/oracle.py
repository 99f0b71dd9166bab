"""DuckDB statements that state the expected result of each registered query over the same tables."""

from __future__ import annotations

from foliomill.operators import chat, enrich, evaluate
from foliomill.operators.sweep import DEFAULT_SETS
from foliomill.plans import inputs, queries

WS = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
FILE = "'/' || source || '/Doc ' || doc_id || '.txt'"
VALID = rf"regexp_replace(text, '^{WS}+|{WS}+$', '', 'g') <> ''"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def words(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '[a-z]+')"


def word_set(text: str) -> str:
    return f"list_distinct({words(text)})"


def named(path: str, suffix: str) -> str:
    rx = rf"'.*\/([^\/]+)\/([^\/]+)\.{suffix}'"
    part = "replace(lower(regexp_extract({p}, {rx}, {g})), ' ', '_')"
    return f"{part.format(p=path, rx=rx, g=1)} || '/' || {part.format(p=path, rx=rx, g=2)}"


def visible(html: str) -> str:
    bare = f"regexp_replace({html}, '(?s)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g')"
    return rf"trim(regexp_replace(regexp_replace({bare}, '<[^>]*>', ' ', 'g'), '[ \t\r\n]+', ' ', 'g'))"


def windows(source: str, keys: str, text: str, size: int, overlap: int) -> str:
    """Rows ``keys, chunk_ix, content_chunk`` cut from ``text`` of ``source``."""
    step = size - overlap
    n = f"greatest(cast(ceil((length({text}) - {overlap}) / {step}.0) AS int), 1)"
    return (
        f"SELECT {keys}, cast(ix AS int) AS chunk_ix, substring({text}, ix * {step} + 1, {size}) AS content_chunk "
        f"FROM (SELECT *, unnest(range(0, {n})) AS ix FROM ({source}) WHERE length({text}) > 0)"
    )


def recursive(source: str, key: str, text: str, size: int, overlap: int) -> str:
    """Rows ``key, chunk_ix, content_chunk`` by the rules of the recursive splitter.

    A text is cut before each of the first separator it has; pieces of ``size`` and more are cut by the next one. Neighbours
    among the shorter ones are packed: a piece that would go beyond ``size`` closes a chunk, and the next one starts at the
    first piece from which on at most ``overlap`` is repeated and the piece fits. ``o`` sorts as the pieces stand.
    """
    steps = [f"n0 AS (SELECT {key} AS k, {text} AS t, [0] AS o FROM ({source}) WHERE length({text}) > 0)"]
    packs = []
    for n, sep in enumerate(("chr(10) || chr(10)", "chr(10)", "' '")):
        cut = f"list_filter(list_transform(string_split(t, {sep}), lambda x, i: CASE WHEN i = 1 THEN x ELSE {sep} || x END), lambda x: x <> '')"
        steps.append(f"""c{n} AS (
            SELECT k, o, p, ix, length(p) >= {size} AS long, sum((length(p) >= {size})::int) OVER (PARTITION BY k, o ORDER BY ix)::int AS run
            FROM (SELECT k, o, unnest(l) AS p, unnest(range(len(l))) AS ix FROM (SELECT k, o, {cut} AS l FROM n{n} WHERE contains(t, {sep}))))""")
        steps.append(f"""n{n + 1} AS (
            SELECT k, p AS t, list_concat(o, [run, 0]) AS o FROM c{n} WHERE long
            UNION ALL SELECT k, t, o FROM n{n} WHERE NOT contains(t, {sep}))""")
        steps.append(f"""p{n} AS (
            SELECT k, list_concat(o, [run, 1]) AS o, string_agg(p, '' ORDER BY ix) AS t, list({{'a': hi - length(p), 'b': hi}} ORDER BY ix) AS l
            FROM (SELECT *, sum(length(p)) OVER (PARTITION BY k, o, run ORDER BY ix) AS hi FROM c{n} WHERE NOT long) GROUP BY k, o, run)""")
        packs.append(f"SELECT k, o, t, l FROM p{n}")
    packs.append("SELECT k, o, t, list_transform(range(length(t)), lambda i: {'a': i, 'b': i + 1}) AS l FROM n3")
    spans = "STRUCT(a BIGINT, b BIGINT)[]"
    fits = f"z >= acc.s AND z <= x.a AND x.a - z <= {overlap} AND (x.b - z <= {size} OR z = x.a)"
    steps.append(f"""f AS (
        SELECT k, o, t, list_reduce(list_transform(l, lambda x: {{'a': x.a::bigint, 'b': x.b::bigint, 's': 0::bigint, 'c': []::{spans}}}),
            lambda acc, x: CASE WHEN x.b - acc.s <= {size} THEN {{'a': x.a, 'b': x.b, 's': acc.s, 'c': acc.c}} ELSE {{'a': x.a, 'b': x.b,
              's': list_min(list_filter(d, lambda z: {fits}))::bigint,
              'c': CASE WHEN x.a > acc.s THEN list_append(acc.c, {{'a': acc.s, 'b': x.a}}) ELSE acc.c END}} END,
            {{'a': 0::bigint, 'b': 0::bigint, 's': 0::bigint, 'c': []::{spans}}}) AS r
        FROM (SELECT *, list_transform(l, lambda x: x.a::bigint) AS d FROM ({' UNION ALL '.join(packs)})))""")
    steps.append(f"""u AS (
        SELECT k, o, unnest(range(len(e))) AS ix, regexp_replace(substring(t, (unnest(e)).a + 1, (unnest(e)).b - (unnest(e)).a), '^{WS}+|{WS}+$', '', 'g') AS c
        FROM (SELECT k, o, t, list_append(r.c, {{'a': r.s, 'b': r.b}}) AS e FROM f))""")
    return f"""(WITH {', '.join(steps)}
        SELECT k AS {key}, (row_number() OVER (PARTITION BY k ORDER BY o, ix) - 1)::int AS chunk_ix, c AS content_chunk FROM u WHERE c <> '')"""


def weights(source: str, key: str, text: str) -> str:
    """Rows ``key, bucket, w`` of the hashed embedding of ``text``."""
    return f"""
        SELECT {key}, bucket, n / sqrt(sum(n * n) OVER (PARTITION BY {key})) AS w FROM (
          SELECT {key}, cast(('0x' || substr(md5(tok), 1, 4)) AS int) % 64 AS bucket, count(*)::double AS n
          FROM (SELECT {key}, unnest({words(text)}) AS tok FROM ({source})) GROUP BY ALL)"""


def printed(source: str, key: str, text: str) -> str:
    return f"""
        SELECT {key}, string_agg(bucket || ':' || cast(round(w * 1000000) AS bigint), ',' ORDER BY bucket) AS embedding_e6
        FROM ({weights(source, key, text)}) GROUP BY {key}"""


SILVER = f"""
    SELECT input_file, (ix - 1)::varchar AS page_nr, l[ix] AS page_content, {named("input_file", "txt")} AS document_name
    FROM (SELECT {FILE} AS input_file, string_split(text, chr(10)) AS l, unnest(range(1, len(l) + 1)) AS ix FROM documents)"""

FIXED_GOLD = f"""
    SELECT md5(input_file || '#' || page_nr || '#' || chunk_ix) AS chunk_id, content_chunk
    FROM ({windows(SILVER, "input_file, page_nr, document_name, page_content", "page_content", 475, 50)})"""

KEYED_SILVER = f"SELECT *, input_file || '#' || page_nr AS page FROM ({SILVER})"
GOLD = f"""
    SELECT md5(page || '#' || chunk_ix) AS chunk_id, input_file, page_nr, document_name, content_chunk,
      timestamp '{inputs.AS_OF}' AS _datetime, page_content
    FROM ({KEYED_SILVER}) JOIN {recursive(KEYED_SILVER, "page", "page_content", 475, 50)} USING (page)"""


def topic(source: str, key: str, text: str) -> str:
    return f"""
        SELECT d.{key}, to_json({{'topic': coalesce(t.tok, '{enrich.NO_TOPIC}')}})::varchar AS topic
        FROM ({source}) d LEFT JOIN (
          SELECT {key}, tok, row_number() OVER (PARTITION BY {key} ORDER BY n DESC, tok) AS r FROM (
            SELECT {key}, tok, count(*) AS n FROM (SELECT {key}, unnest({words(text)}) AS tok FROM ({source}))
            WHERE length(tok) >= {enrich.MIN_TOPIC_LETTERS} GROUP BY ALL)) t ON t.{key} = d.{key} AND t.r = 1"""


PAGES = f"SELECT page_id, url, {visible('html')} AS t, octet_length(encode(html))::bigint AS length FROM pages"
HTML_ONLY = f"SELECT * FROM ({PAGES}) WHERE url LIKE '%.html'"

CHANGES = """
    SELECT *, CASE event_type WHEN 'error' THEN 'delete' WHEN 'signup' THEN 'insert' WHEN 'view' THEN 'update_preimage'
      ELSE 'update_postimage' END AS ct FROM events"""
EVENT = "event_id, ts, user_id, event_type, value, props"
CURRENT = f"""
    SELECT {EVENT} FROM ({CHANGES}) WHERE ct <> 'update_preimage'
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1 AND ct <> 'delete'"""

BEFORE = "SELECT doc_id, text, lang FROM documents LEFT JOIN labels USING (doc_id) WHERE coalesce(quality, 1) = 1"
AFTER = f"""
    SELECT doc_id, regexp_replace(text, '{inputs.JUNK_RUN}', '', 'g') AS text, lang
    FROM documents LEFT JOIN labels USING (doc_id) WHERE coalesce(toxic, 0) = 0"""

COSINE = "round(list_cosine_similarity(q.embedding::double[], i.embedding::double[]), 6)"


def nearest(k: int, where: str = "true") -> str:
    return f"""
        SELECT q.vec_id AS query_id, i.vec_id AS id, {COSINE} AS score,
          row_number() OVER (PARTITION BY q.vec_id ORDER BY {COSINE} DESC, i.vec_id) AS rank, q.label AS q_label, i.label AS i_label
        FROM embeddings q JOIN embeddings i ON q.vec_id <> i.vec_id AND {where} QUALIFY rank <= {k}"""


RECALL = f"""
    SELECT query_id, n_hits, n_relevant, CASE WHEN n_relevant > 0 THEN round(n_hits / n_relevant::double, 6) END AS recall FROM (
      SELECT query_id, cast(sum((q_label = i_label)::int) AS bigint) AS n_hits, any_value(n) - 1 AS n_relevant
      FROM ({nearest(3)}) JOIN (SELECT label, count(*) AS n FROM embeddings GROUP BY 1) ON label = q_label GROUP BY 1)"""


def mmr(k: int, fetch_k: int, weight: float) -> str:
    steps = [f"cand AS (SELECT query_id, id, score FROM ({nearest(fetch_k)}))"]
    picked = []
    for step in range(1, k + 1):
        if step == 1:
            source, closest = "cand c", "0.0::double"
        else:
            chosen = " UNION ALL ".join(f"SELECT query_id, id FROM p{s}" for s in range(1, step))
            steps.append(
                f"""near{step} AS (SELECT c.query_id, c.id, any_value(c.score) AS score,
                    max({COSINE.replace("q.", "a.").replace("i.", "b.")}) AS closest
                  FROM cand c JOIN ({chosen}) s ON s.query_id = c.query_id
                  JOIN embeddings a ON a.vec_id = c.id JOIN embeddings b ON b.vec_id = s.id
                  WHERE (c.query_id, c.id) NOT IN (SELECT (query_id, id) FROM ({chosen})) GROUP BY 1, 2)"""
            )
            source, closest = f"near{step} c", "closest"
        steps.append(
            f"""p{step} AS (SELECT query_id, {step} AS step, id,
                round({weight}::double * score - (1.0::double - {weight}::double) * {closest}, 9) AS mmr_score FROM {source}
              QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY mmr_score DESC, id) = 1)"""
        )
        picked.append(f"SELECT query_id, step::int AS step, id, mmr_score FROM p{step}")
    return f"WITH {', '.join(steps)} {' UNION ALL '.join(picked)}"


def question_hits(chunks: str, k: int) -> str:
    """Best ``k`` chunks (``chunk_id, content_chunk``) for each benchmark text."""
    return f"""
        SELECT item_id, chunk_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, chunk_id) AS rank FROM (
          SELECT q.item_id, c.chunk_id, round(sum(q.w * c.w), 6) AS score
          FROM ({weights("SELECT item_id, text FROM benchmark", "item_id", "text")}) q
          JOIN ({weights(chunks, "chunk_id", "content_chunk")}) c USING (bucket) GROUP BY 1, 2)
        QUALIFY rank <= {k}"""


ANSWERED = """
    SELECT q.conv_id, q.turn, q.text AS question, a.text AS answer FROM conversations q
    JOIN conversations a ON a.conv_id = q.conv_id AND a.turn = q.turn + 1 AND a.role = 'assistant' WHERE q.role = 'user'"""
SETS = f"SELECT conv_id, turn, answer, {word_set('question')} AS q, {word_set('answer')} AS a FROM ({ANSWERED})"
EXPECTED = f"SELECT doc_id AS conv_id, {word_set('text')} AS e FROM documents JOIN labels USING (doc_id) WHERE quality = 1"
CONTEXT = f"SELECT page_id AS conv_id, {word_set('t')} AS c FROM ({PAGES})"
CHUNK_SETS = f"""
    SELECT conv_id, list({word_set("content_chunk")} ORDER BY chunk_ix) AS cs
    FROM ({windows(f"SELECT page_id AS conv_id, t FROM ({PAGES})", "conv_id", "t", 475, 50)}) GROUP BY 1"""


def common(a: str, b: str) -> str:
    return f"len(list_intersect({a}, {b}))"


def share(part: str, whole: str) -> str:
    """Null where a side is missing."""
    return f"CASE WHEN {part} IS NULL OR {whole} IS NULL THEN NULL WHEN {whole} > 0 THEN round(({part}) / ({whole})::double, 6) ELSE 0.0 END"


def reason(**needed: str) -> str:
    return "nullif(concat_ws(', ', " + ", ".join(f"CASE WHEN {c} IS NULL THEN {quote(t)} END" for c, t in needed.items()) + "), '') AS reason"


NO_E, NO_C = "no expected response", "no context"


CORRECTNESS = share(f"2 * {common('a', 'e')}", "(len(a) + len(e))")
SUFFICIENCY = share(common("e", "c"), "len(e)")
RELEVANCE = share(common("q", "a"), f"(len(q) + len(a) - {common('q', 'a')})")
GROUNDED = share(common("a", "c"), "len(a)")
CHUNK_RELEVANCE = share(f"list_sum(list_transform(cs, lambda x: {common('q', 'x')}))", "(len(q) * len(cs))")
SAFETY = "SELECT doc_id AS conv_id, 1 - toxic AS safety FROM labels"


def follows(rule: evaluate.Guideline, text: str) -> str:
    found = f"regexp_matches({text}, {quote(rule.pattern)})"
    return f"({found if rule.must else f'NOT {found}'})::int"


LABELLED = "SELECT doc_id, lang, quality, toxic, 1 - toxic AS safety FROM documents JOIN labels USING (doc_id)"
MESSAGE = "{'role': role, 'content': text}"


def memories() -> str:
    return f"""
        SELECT 'memories' AS namespace, conv_id % {inputs.N_USERS} AS user_id, md5(conv_id || '#' || turn) AS key, text AS data
        FROM conversations WHERE role = 'user' AND contains(lower(text), '{inputs.KEYWORD}')"""


ASKED = f"""
    SELECT user_id, text AS query FROM (
      SELECT conv_id % {inputs.N_USERS} AS user_id, text,
        row_number() OVER (PARTITION BY conv_id % {inputs.N_USERS} ORDER BY conv_id DESC, turn DESC) AS r
      FROM conversations WHERE role = 'user') WHERE r = 1"""
MEMORY_SCORES = f"""
    SELECT m.user_id, key, data, {share(common(word_set("query"), word_set("data")), f"len({word_set('query')})")} AS score
    FROM ({memories()}) m JOIN ({ASKED}) q ON q.user_id = m.user_id"""
MEMORY_HITS = f"""
    SELECT * FROM (
      SELECT *, cast(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, key) AS int) AS rank FROM ({MEMORY_SCORES}))
    WHERE rank <= {chat.MEMORY_LIMIT}"""


def key_check(source: str, key: str, rule: str) -> str:
    return f"""
        SELECT '{rule}' AS rule, cast(sum(n) AS bigint) AS n_rows, cast(0 AS bigint) AS n_null_rows,
          cast(sum((n > 1)::int) AS bigint) AS n_repeated_keys, cast(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS bigint) AS n_repeated_rows
        FROM (SELECT {key}, count(*) AS n FROM {source} GROUP BY ALL)"""


def sweep_stats() -> str:
    runs = []
    for p in queries.SWEEP_SETS:
        cut = windows("SELECT doc_id, text FROM documents", "doc_id", "text", p.chunk_size, p.chunk_overlap)
        runs.append(
            f"""SELECT '{p.run_id}' AS run_id, {p.chunk_size}::int AS chunk_size, {p.chunk_overlap}::int AS chunk_overlap,
              count(*) AS n_chunks, cast(sum(n) AS bigint) AS n_chars, cast(min(n) AS int) AS min_chars,
              cast(max(n) AS int) AS max_chars, round(avg(n), 6) AS avg_chars FROM (SELECT length(content_chunk) AS n FROM ({cut}))"""
        )
    return " UNION ALL ".join(runs)


def sweep_scores() -> str:
    runs = []
    for p in DEFAULT_SETS:
        cut = windows("SELECT doc_id, text FROM documents", "doc_id", "text", p.chunk_size, p.chunk_overlap)
        chunks = f"SELECT md5(doc_id || '#' || chunk_ix) AS chunk_id, content_chunk FROM ({cut})"
        runs.append(
            f"""SELECT '{p.run_id}' AS run_id, count(*) AS n_results, round(avg(score), 6) AS mean_score, max(score) AS best_score
              FROM ({question_hits(chunks, p.top_k)})"""
        )
    return " UNION ALL ".join(runs)


def gate() -> str:
    limits = " UNION ALL ".join(f"SELECT '{m}' AS metric, {v}::double AS threshold" for m, v in queries.GATE.items())
    return f"""
        SELECT metric, round(value, 6) AS value, threshold, (value >= threshold)::int AS passed,
          min((value >= threshold)::int) OVER () AS gate_open
        FROM (SELECT 'judge_mean' AS metric, (avg(quality) + avg(safety)) / 2 AS value FROM ({LABELLED})
              UNION ALL SELECT 'recall_at_3', avg(recall) FROM ({RECALL})) JOIN ({limits}) USING (metric)"""


def sampled() -> str:
    flags = ", ".join(
        f"(bucket < {round(r * evaluate.SAMPLE_BUCKETS)})::int AS sampled_{n}" for n, r in evaluate.MONITOR_RATES.items()
    )
    return f"""
        SELECT *, {flags} FROM (SELECT conv_id, turn,
          cast(('0x' || substr(md5(conv_id || '#' || turn), 1, 8)) AS bigint) % {evaluate.SAMPLE_BUCKETS} AS bucket
          FROM conversations WHERE role = 'user')"""


RECENT = f"ts > (SELECT max(ts) FROM events) - INTERVAL {queries.TRACE_MINUTES} MINUTE"


def recursive_check(size: int, overlap: int) -> str:
    chunks = recursive("SELECT doc_id, text FROM documents", "doc_id", "text", size, overlap)
    return f"""
        SELECT doc_id, coalesce(n, 0) AS n_chunks, md5(coalesce(whole, '')) AS chunks_md5 FROM documents LEFT JOIN (
          SELECT doc_id, count(*) AS n, string_agg(content_chunk, chr(31) ORDER BY chunk_ix) AS whole FROM {chunks} GROUP BY doc_id)
        USING (doc_id)"""


def rendered() -> str:
    item = "'<li>' || x.doc_name || ' - Page ' || x.page_nr || '</li>'"
    pair = (
        "[{'doc_name': source, 'page_nr': n_chars::varchar}, {'doc_name': lang || '-' || source, 'page_nr': doc_id::varchar}]"
    )
    return f"""
        SELECT doc_id, replace(text, chr(10), '<br/>') || CASE WHEN lang = 'es' THEN '' ELSE {quote(chat.SOURCES_OPEN)} ||
          CASE WHEN lang = 'de' THEN '' ELSE array_to_string(list_transform({pair}, lambda x: {item}), chr(10)) END
          || {quote(chat.SOURCES_CLOSE)} END AS rendered FROM documents"""


def statements() -> dict[str, str]:
    chunk_text = "SELECT chunk_id, content_chunk"
    return {
        "bronze_pages": "SELECT url AS path, octet_length(encode(html))::bigint AS length, md5(html) AS content_md5 FROM pages",
        "bronze_scan": "SELECT lang, cast(sum(octet_length(encode(text)) + 1) AS bigint) AS n_bytes FROM documents GROUP BY lang",
        "bronze_stream": "SELECT lang, cast(sum(octet_length(encode(text)) + 1) AS bigint) AS n_bytes FROM documents GROUP BY lang",
        "evaluation_set": f"""
            WITH e AS (SELECT *, md5(event_type || '#' || props) AS input_hash FROM events),
            t AS (SELECT input_hash, max(event_id) AS id FROM e WHERE event_type <> 'error' AND {RECENT} GROUP BY 1),
            k AS (SELECT input_hash, max(event_id) AS id, arg_max(value, event_id) AS expected FROM e
                  WHERE event_type = 'purchase' GROUP BY 1)
            SELECT input_hash, coalesce(t.id, k.id) AS event_id, expected,
              CASE WHEN t.id IS NULL THEN 'existing' ELSE 'incoming' END AS origin FROM t FULL JOIN k USING (input_hash)""",
        "filter_suffix": "SELECT page_id, url FROM pages WHERE url LIKE '%.html'",
        "ingest_changed_files": """
            SELECT 'user-' || user_id AS path, max(ts) AS "modificationTime" FROM events GROUP BY user_id
            HAVING max(ts) IS DISTINCT FROM max(ts) FILTER (event_type <> 'error')""",
        "stream_ingest": f"SELECT {EVENT} FROM events",
        "append_flow": """
            SELECT event_id, user_id, event_type, CASE WHEN event_type = 'error' THEN 'failures' ELSE 'activity' END AS flow
            FROM events""",
        "snapshot_ctas": "SELECT doc_id, lang, source, n_chars, md5(text) AS text_md5 FROM documents",
        "silver_pages": SILVER,
        "document_name": f"SELECT page_id, url, {named('url', 'html')} AS document_name FROM pages",
        "html_text": f"SELECT page_id, t AS extracted_text FROM ({PAGES})",
        "doc_text": f"SELECT {FILE} AS input_file, replace(text, chr(10), '') AS extracted_text FROM documents",
        "chunk_fixed": windows("SELECT doc_id, text FROM documents", "doc_id", "text", 475, 50),
        "chunk_recursive": recursive_check(475, 50),
        "chunk_recursive_small": recursive_check(100, 20),
        "gold_table": GOLD,
        "gold_incremental": f"""
            SELECT url AS path, length, topic, topic AS parsed_topic_str, chunk_ix, content_chunk AS chunked_text
            FROM {recursive(HTML_ONLY, "page_id", "t", 100, 20)} JOIN ({HTML_ONLY}) USING (page_id)
            JOIN ({topic(HTML_ONLY, "page_id", "t")}) USING (page_id)""",
        "doc_coverage": f"""
            SELECT reason, count(*) AS n_pages, cast(sum(n) AS bigint) AS n_chunks FROM (
              SELECT CASE WHEN url NOT LIKE '%.html' THEN 'not eligible' WHEN t = '' THEN 'blank text' ELSE 'chunked' END AS reason,
                CASE WHEN reason = 'chunked' THEN greatest(cast(ceil((length(t) - 50) / 425.0) AS int), 1) ELSE 0 END AS n
              FROM ({PAGES})) GROUP BY reason""",
        "union_modalities": f"""
            SELECT 'documents/' || doc_id AS path, text AS extracted_text, lang, NULL::bigint AS page_id FROM documents
            UNION ALL SELECT url, t, NULL, page_id FROM ({PAGES})""",
        "prompt_build": f"""
            SELECT doc_id, md5({quote(inputs.PROMPT)} || text) AS request_md5, length({quote(inputs.PROMPT)} || text) AS n_chars
            FROM documents""",
        "topic_enrich": f"""
            SELECT doc_id, topic, topic AS parsed_topic_str FROM ({topic("SELECT doc_id, text FROM documents", "doc_id", "text")})""",
        "json_fields": """
            SELECT event_id, cast(props->>'k' AS int) AS k, to_json({'k': cast(props->>'k' AS int)})::varchar AS props_json FROM events""",
        "change_feed": f"""
            SELECT * FROM (
              WITH o AS ({BEFORE}), n AS ({AFTER}), j AS (
                SELECT coalesce(o.doc_id, n.doc_id) AS doc_id, o.doc_id IS NULL AS ins, n.doc_id IS NULL AS del,
                  o.text AS ot, o.lang AS ol, n.text AS nt, n.lang AS nl
                FROM o FULL JOIN n ON o.doc_id = n.doc_id)
              SELECT doc_id, nt AS text, nl AS lang, 'insert' AS _change_type, 1::bigint AS _commit_version FROM j WHERE ins
              UNION ALL SELECT doc_id, ot, ol, 'delete', 1 FROM j WHERE del
              UNION ALL SELECT doc_id, ot, ol, 'update_preimage', 1 FROM j WHERE NOT ins AND NOT del AND ot <> nt
              UNION ALL SELECT doc_id, nt, nl, 'update_postimage', 1 FROM j WHERE NOT ins AND NOT del AND ot <> nt)""",
        "cdc_scd1": CURRENT,
        "cdc_scd1_stream": CURRENT,
        "cdc_scd2": f"""
            SELECT {EVENT}, ts AS "__START_AT", next_ts AS "__END_AT" FROM (
              SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_ts FROM ({CHANGES})
              WHERE ct <> 'update_preimage') WHERE ct <> 'delete'""",
        "key_violations": " UNION ALL ".join(
            [
                key_check("documents", "doc_id", "documents by doc_id"),
                key_check("documents", "text", "documents by text"),
                key_check("conversations", "conv_id, turn", "conversations by conv_id, turn"),
                key_check("conversations", "conv_id", "conversations by conv_id"),
            ]
        ),
        "merge_records": """
            SELECT input_hash, coalesce(max(doc_id) FILTER (quality IS NULL), max(doc_id)) AS doc_id,
              arg_max(quality, doc_id) AS expected,
              CASE WHEN count(*) FILTER (quality IS NULL) > 0 THEN 'incoming' ELSE 'existing' END AS origin
            FROM (SELECT doc_id, md5(text) AS input_hash, quality FROM documents LEFT JOIN labels USING (doc_id)) GROUP BY 1""",
        "identity_ids": f"""
            SELECT input_file, page_nr,
              {queries.LAST_USED_ID} + row_number() OVER (ORDER BY md5(input_file || '#' || page_nr), input_file, page_nr) AS id
            FROM ({SILVER})""",
        "embed_hashed": f"""
            SELECT item_id, bucket::int AS bucket, round(w, 6) AS weight
            FROM ({weights("SELECT item_id, text FROM benchmark", "item_id", "text")})""",
        "index_build": f"""
            SELECT chunk_id, md5(content_chunk) AS text_hash, coalesce(embedding_e6, '') AS embedding_e6 FROM ({FIXED_GOLD})
            LEFT JOIN ({printed(f"{chunk_text} FROM ({FIXED_GOLD})", "chunk_id", "content_chunk")}) USING (chunk_id)""",
        "index_sync": f"""
            SELECT * FROM (
              WITH o AS ({BEFORE}), n AS ({AFTER}), p AS (
                SELECT coalesce(o.doc_id, n.doc_id) AS doc_id, n.text,
                  CASE WHEN o.doc_id IS NULL THEN 'insert' WHEN n.doc_id IS NULL THEN 'delete' WHEN o.text = n.text THEN 'keep'
                    ELSE 'update' END AS action
                FROM o FULL JOIN n ON o.doc_id = n.doc_id)
              SELECT doc_id, action, CASE WHEN action IN ('insert', 'update') THEN coalesce(embedding_e6, '') END AS embedding_e6
              FROM p LEFT JOIN (
                {printed("SELECT doc_id, text FROM p WHERE action IN ('insert', 'update')", "doc_id", "text")}) USING (doc_id))""",
        "index_after_sync": f"""
            SELECT doc_id, md5(text) AS text_hash, coalesce(embedding_e6, '') AS embedding_e6 FROM ({AFTER})
            LEFT JOIN ({printed(AFTER, "doc_id", "text")}) USING (doc_id)""",
        "vector_topk": f"SELECT query_id, id, score, rank FROM ({nearest(queries.TOP_K)})",
        "vector_topk_blocks": f"SELECT query_id, id, score, rank FROM ({nearest(queries.TOP_K)})",
        "vector_topk_filtered": f"SELECT query_id, id, score, rank FROM ({nearest(queries.TOP_K, 'i.label = 3')})",
        "vector_threshold": f"""
            SELECT query_id, id, score, rank FROM ({nearest(queries.TOP_K)}) WHERE score >= {queries.THRESHOLD}""",
        "vector_mmr": mmr(3, 10, 0.5),
        "vector_ivf_recall": f"""
            SELECT count(DISTINCT query_id) AS n_queries, count(*) AS n_wanted, true AS enough
            FROM ({nearest(queries.IVF_K, "q.vec_id % 20 = 0")})""",
        "recall_at_3": RECALL,
        "retrieve_chunks": question_hits(f"{chunk_text} FROM ({FIXED_GOLD})", queries.TOP_K),
        "eval_allocation": f"""
            SELECT doc_id, cast({queries.N_QUESTIONS} // count(*) OVER () AS bigint)
              + (row_number() OVER (ORDER BY md5(doc_id::varchar), doc_id) <= {queries.N_QUESTIONS} % count(*) OVER ())::bigint
              AS n_questions FROM documents""",
        "score_correctness": f"SELECT conv_id, turn, {CORRECTNESS} AS correctness, {reason(e=NO_E)} FROM ({SETS}) LEFT JOIN ({EXPECTED}) USING (conv_id)",
        "score_sufficiency": f"""
            SELECT conv_id, turn, {SUFFICIENCY} AS sufficiency, {reason(e=NO_E, c=NO_C)} FROM ({SETS})
            LEFT JOIN ({EXPECTED}) USING (conv_id) LEFT JOIN ({CONTEXT}) USING (conv_id)""",
        "score_relevance": f"SELECT conv_id, turn, {RELEVANCE} AS relevance FROM ({SETS})",
        "score_groundedness": f"SELECT conv_id, turn, {GROUNDED} AS groundedness, {reason(c=NO_C)} FROM ({SETS}) LEFT JOIN ({CONTEXT}) USING (conv_id)",
        "score_chunk_relevance": f"""
            SELECT conv_id, turn, {CHUNK_RELEVANCE} AS chunk_relevance, {reason(cs=NO_C)}
            FROM ({SETS}) LEFT JOIN ({CHUNK_SETS}) USING (conv_id)""",
        "score_safety": f"SELECT lang, count(*) AS n_rows, round(avg(safety), 6) AS safety FROM ({LABELLED}) GROUP BY lang",
        "score_guidelines": " UNION ALL ".join(
            f"SELECT conv_id, turn, '{r.name}' AS guideline, {follows(r, 'text')} AS passed FROM conversations WHERE role = 'assistant'"
            for r in evaluate.GUIDELINES
        ),
        "score_panel": f"""
            SELECT conv_id, turn, {CORRECTNESS} AS correctness, {SUFFICIENCY} AS sufficiency, {RELEVANCE} AS relevance,
              {GROUNDED} AS groundedness, {CHUNK_RELEVANCE} AS chunk_relevance, safety,
              {", ".join(f"{follows(r, 'answer')} AS {r.name}" for r in evaluate.GUIDELINES)},
              {reason(e=NO_E, c=NO_C, safety="no label")}
            FROM ({SETS}) LEFT JOIN ({EXPECTED}) USING (conv_id) LEFT JOIN ({CONTEXT}) USING (conv_id)
            LEFT JOIN ({CHUNK_SETS}) USING (conv_id) LEFT JOIN ({SAFETY}) USING (conv_id)""",
        "monitor_sample": sampled(),
        "monitor_scores": f"""
            SELECT conv_id, turn, CASE WHEN sampled_safety = 1 THEN safety END AS safety,
              CASE WHEN sampled_groundedness = 1 THEN {GROUNDED} END AS groundedness,
              CASE WHEN sampled_relevance_to_query = 1 THEN {RELEVANCE} END AS relevance_to_query,
              CASE WHEN sampled_chunk_relevance = 1 THEN {CHUNK_RELEVANCE} END AS chunk_relevance,
              {reason(a="no answer", c=NO_C, safety="no label")}
            FROM ({sampled()}) LEFT JOIN ({SETS}) USING (conv_id, turn) LEFT JOIN ({CONTEXT}) USING (conv_id)
            LEFT JOIN ({CHUNK_SETS}) USING (conv_id) LEFT JOIN ({SAFETY}) USING (conv_id)""",
        "trace_window": f"""
            SELECT event_id, ts, 'OK' AS status, row_number() OVER (ORDER BY ts DESC, event_id) AS rank
            FROM events WHERE event_type <> 'error' AND {RECENT}""",
        "trace_counts": f"""
            SELECT CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'OK' END AS status, count(*) AS n_traces,
              cast(sum(({RECENT})::int) AS bigint) AS n_recent FROM events GROUP BY 1""",
        "judge_means": f"""
            SELECT lang, round(avg(quality), 6) AS mean_quality, round(avg(safety), 6) AS mean_safety,
              round((avg(quality) + avg(safety)) / 2, 6) AS mean_of_means FROM ({LABELLED}) GROUP BY lang""",
        "quality_gate": gate(),
        "sweep_chunks": sweep_stats(),
        "sweep_compare": sweep_scores(),
        "valid_messages": f"SELECT conv_id, turn, role, text FROM conversations WHERE {VALID}",
        "memory_candidates": f"SELECT conv_id, turn, text FROM conversations WHERE contains(lower(text), '{inputs.KEYWORD}')",
        "thread_messages": f"""
            SELECT conv_id, turn // {chat.PAGE_TURNS} AS page, count(*) AS n_messages,
              to_json(list({MESSAGE} ORDER BY turn))::varchar AS messages_json FROM conversations WHERE {VALID} GROUP BY 1, 2""",
        "history_arrays": f"""
            SELECT conv_id, turn, turn // {chat.PAGE_TURNS} AS earlier_pages, len(h)::bigint AS n_messages,
              to_json(h)::varchar AS messages_json FROM (
                SELECT *, list({MESSAGE}) OVER (PARTITION BY conv_id, turn // {chat.PAGE_TURNS} ORDER BY turn
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS h FROM conversations) WHERE role = 'user'""",
        "last_message": """
            SELECT conv_id, turn, role, text FROM conversations
            QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1""",
        "with_system": f"""
            WITH m AS (SELECT conv_id, turn // {chat.PAGE_TURNS} AS page, list({MESSAGE} ORDER BY turn) AS m FROM conversations
              WHERE role <> 'system' GROUP BY 1, 2),
            s AS (SELECT conv_id, arg_max(text, turn) AS s FROM conversations WHERE role = 'system' GROUP BY 1),
            p AS (SELECT s.conv_id, coalesce(min(m.page), 0) AS page, any_value(s) AS s FROM s LEFT JOIN m USING (conv_id) GROUP BY 1)
            SELECT conv_id, page, to_json(list_concat(CASE WHEN s IS NOT NULL THEN [{{'role': 'system', 'content': s}}] ELSE [] END,
              coalesce(m, [])))::varchar AS messages_json FROM m FULL JOIN p USING (conv_id, page)""",
        "full_history": f"""
            WITH r AS (SELECT conv_id, max(turn) AS asked FROM conversations WHERE role = 'user' GROUP BY 1)
            SELECT conv_id, asked AS turn, turn // 4 AS page, cast(sum(count(*)) OVER (PARTITION BY conv_id) AS bigint) AS n_messages,
              to_json(list({MESSAGE} ORDER BY turn))::varchar AS messages_json
            FROM conversations JOIN r USING (conv_id) WHERE turn <= asked GROUP BY conv_id, asked, turn // 4""",
        "pairs_to_messages": f"""
            SELECT conv_id, turn, 0::int AS position, 'user' AS role, question AS content FROM ({ANSWERED})
            UNION ALL SELECT conv_id, turn, 1, 'assistant', answer FROM ({ANSWERED})""",
        "normalize_response": """
            SELECT conv_id, turn, CASE WHEN role = 'system' THEN 'rejected' ELSE 'ok' END AS status,
              CASE WHEN role <> 'system' THEN role END AS role, CASE WHEN role <> 'system' THEN text END AS content FROM conversations""",
        "sources_render": rendered(),
        "memory_put": memories(),
        "memory_search": f"SELECT * FROM ({MEMORY_HITS})",
        "memory_context": f"""
            SELECT user_id, {quote(inputs.SYSTEM_INTRO)} || string_agg(data, chr(10) ORDER BY rank) AS system_message
            FROM ({MEMORY_HITS}) GROUP BY user_id""",
    }
