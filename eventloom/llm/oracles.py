"""DuckDB SQL for the queries that SQL can express."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

URL_FILTERS = f"""
WITH parsed AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
rules(rule_host, rule_path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
         ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
best AS (
  SELECT page_id, host, path, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         max_by(verdict, length(rule_host || rule_path)) AS verdict
  FROM parsed LEFT JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id, host, path)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM best
"""


def license_sql() -> str:
    from eventloom.llm.licenses import RULES, SENTENCES, normalized_text

    known = ", ".join(f"('{normalized_text(text)}', '{name}')" for name, text in SENTENCES.items())
    rules = ", ".join(f"('{name}', ' {'  '.join(ids)} ')" for name, ids in RULES)
    return f"""
WITH cut AS (
  SELECT doc_id, unnest(regexp_split_to_array(coalesce(text, ''), '[.!?:]+[ \\t\\r\\n\\f]+|[\\r\\n]+')) AS sentence,
         generate_subscripts(regexp_split_to_array(coalesce(text, ''), '[.!?:]+[ \\t\\r\\n\\f]+|[\\r\\n]+'), 1) AS nth
  FROM documents),
known(sentence, id) AS (VALUES {known}),
rules(name, ids) AS (VALUES {rules}),
found AS (
  SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY nth) AS ids,
         ' ' || string_agg(id, '  ' ORDER BY nth) || ' ' AS in_order
  FROM cut JOIN known
    ON trim(regexp_replace(translate(cut.sentence, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g')) = known.sentence
  GROUP BY doc_id),
named AS (
  SELECT doc_id, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses
  FROM found JOIN rules ON contains(in_order, rules.ids) GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_sentences, coalesce(ids, '') AS sentence_ids, coalesce(licenses, '') AS licenses
FROM documents LEFT JOIN found USING (doc_id) LEFT JOIN named USING (doc_id)
"""


WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), " + r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {WORDS} AS words FROM documents),
b AS (SELECT item_id, {WORDS} AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(words)) AS w, array_to_string(words[s : s + least(10, len(words)) - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS s FROM b WHERE len(words) > 0)),
places AS (
  SELECT doc_id, w, s, array_to_string(words[s : s + w - 1], ' ') AS win
  FROM (SELECT doc_id, words, w, unnest(range(1, len(words) - w + 2)) AS s
        FROM d CROSS JOIN (SELECT DISTINCT w FROM windows))),
hits AS (SELECT doc_id, s, w, item_id FROM places JOIN windows USING (w, win)),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + w)) AS p FROM (SELECT DISTINCT doc_id, s, w FROM hits)) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

ESCAPED = r"replace(replace(replace(replace({0}, '\', '\b'), '</turn>', '\t'), '<part/>', '\p'), '### ', '\h')"
CHAT = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
placed AS (
  SELECT *, row_number() OVER w AS i, lag(role) OVER w AS before
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(8 + sum(length({ESCAPED.format('text')}) + CASE WHEN before = role THEN 7
            ELSE length({ESCAPED.format('role')}) + CASE WHEN i = 1 THEN 5 ELSE 13 END END) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id
"""


def checksum_table() -> str:
    """The 256 entries of the CRC-32 table, made by its rule."""
    entries = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        entries.append(value)
    return ", ".join(map(str, entries))


def repair_sql() -> str:
    """Row by row from the last: the cheapest rest from each state as cost, letters and text, compared in that order."""
    name = "coalesce(CAST({} AS VARCHAR), ' ')".format
    key = f"{name('conv_id')} || ':' || {name('turn')}"
    crc = f"""xor(4294967295::UBIGINT, list_reduce(
        list_prepend(4294967295::UBIGINT, list_transform(string_split({key}, ''), lambda c: CAST(ord(c) AS UBIGINT))),
        lambda sum, c: xor(sum >> 8, t[1 + CAST(xor(sum, c) & 255 AS BIGINT)])))"""
    solid, space = r"[^\x20\x09-\x0D]", r"[\x20\x09-\x0D]"
    # a rest is its cost in 15 digits, letters, a sign below all letters, and the text; 9... where there is none
    no_way = "'999999999999999'"

    def ahead(cost: str, letter: str, line: str, rest: str) -> str:
        after = f"substr({rest}, strpos({rest}, chr(1)) + 1)"
        text = f"{line} || {after}" if line else after
        return (
            f"CASE WHEN {rest} = {no_way} THEN {no_way} ELSE lpad(CAST(CAST(left({rest}, 15) AS BIGINT) + {cost} AS VARCHAR), 15, '0')"
            f" || '{letter}' || substr({rest}, 16, strpos({rest}, chr(1)) - 16) || chr(1) || {text} END"
        )

    def own(state: int) -> str:
        keeps = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})[state]
        role, after = ("user", 2) if state != 2 else ("assistant", 3)
        extra = "CASE WHEN r.truncated THEN 5 ELSE 0 END"
        ways = [ahead("2", "D", "", f"p.s{state}")]
        for initial, to in keeps.items():
            kept = ahead(extra, "K", "chr(10) || r.role || ':' || r.text", f"p.s{to}")
            ways.append(f"CASE WHEN NOT r.gone AND left(r.role, 1) = '{initial}' THEN {kept} ELSE {no_way} END")
        changed = ahead(f"1 + {extra}", "R", f"chr(10) || '{role}:' || r.text", f"p.s{after}")
        return f"least({', '.join([*ways, f'CASE WHEN NOT r.gone THEN {changed} ELSE {no_way} END'])})"

    def inserted(state: int) -> str:
        role, after = ("user", 2) if state != 2 else ("assistant", 3)
        role_too, then = ("user", 2) if after != 2 else ("assistant", 3)
        twice = ahead("5", "I", f"chr(10) || '{role_too}:'", f"s{then}")
        once = ahead("5", "I", f"chr(10) || '{role}:'", f"s{after}")
        both = ahead("5", "I", f"chr(10) || '{role}:'", "w")
        return f"least(s{state}, {once}, list_transform([{twice}], lambda w: {both})[1]) AS s{state}"

    states = range(4)
    bare = ", ".join(f"{own(s)} AS s{s}" for s in states)
    closed = ", ".join(map(inserted, states))
    ends = "'000000000000000' || chr(1)", "'000000000000010II' || chr(1) || chr(10) || 'user:' || chr(10) || 'assistant:'", \
        "'000000000000005I' || chr(1) || chr(10) || 'assistant:'", "'000000000000000' || chr(1)"
    return f"""
WITH RECURSIVE entries AS (SELECT [{checksum_table()}]::UBIGINT[] AS t),
told AS (
  SELECT conv_id, turn, {name('role')} AS role, {name('text')} AS text, {crc} % 20 AS fault FROM conversations, entries),
hurt AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) FROM told WHERE fault <> 0)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         count(*) OVER (PARTITION BY conv_id) AS n,
         NOT regexp_matches(text, '{solid}') AS blank,
         NOT regexp_matches(text, '[.!?]{space}*$') AS cut
  FROM hurt),
seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
r AS (
  SELECT *, blank OR again AS gone, NOT blank AND NOT again AND cut AS truncated,
         coalesce(CAST(conv_id AS VARCHAR), ' ') AS conv FROM seen),
counts AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND again) AS duplicate,
         count(*) FILTER (truncated) AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY conv),
p AS (
  SELECT conv, n AS i, {", ".join(f"{e} AS s{s}" for s, e in zip(states, ends))} FROM r WHERE i = n
  UNION ALL
  SELECT conv, i, {closed} FROM (
    SELECT r.conv, p.i - 1 AS i, {bare} FROM p JOIN r ON r.conv = p.conv AND r.i = p.i)),
best AS (SELECT conv, s0 FROM p WHERE i = 0)
SELECT ids.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(coalesce(left(s0, 15), '0') AS BIGINT) AS cost,
       coalesce(substr(s0, 16, strpos(s0, chr(1)) - 16), '') AS audit,
       sha256(coalesce(substr(s0, strpos(s0, chr(1)) + 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids
LEFT JOIN counts ON counts.conv = coalesce(CAST(ids.conv_id AS VARCHAR), ' ')
LEFT JOIN best ON best.conv = coalesce(CAST(ids.conv_id AS VARCHAR), ' ')
"""


ORACLES = {
    "op2_url_filters": URL_FILTERS,
    "op3_license_scans": license_sql(),
    "op4_benchmark_decontamination": DECONTAMINATION,
    "op7_chat_formatting": CHAT,
    "op12_conversation_repair": repair_sql(),
}
