"""The queries of this folder in SQL over the same tables.

Each statement is a chain of common table expressions ending in a select. The
formula parser is written relationally, token by token, on purpose: it shares
no step with the column expressions it checks.
"""

from __future__ import annotations

from moniker.functions.elements import SYMBOLS
from workload.inputs import REJECTED_FORMULAS
from workload.queries import BATCH_SIZE, PARTS, SECTION

# Name -> (names it needs, definition). Rendered in order of need.
_CTES: dict[str, tuple[list[str], str]] = {}


def _cte(name: str, needs: list[str], sql: str) -> None:
    _CTES[name] = (needs, sql)


def _with(needs: list[str], select: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for other in _CTES[name][0]:
            visit(other)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        visit(name)
    bodies = ",\n".join(f"{name} AS ({_CTES[name][1]})" for name in ordered)
    return f"WITH RECURSIVE {bodies}\n{select}" if ordered else select


def _strings(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _cas_word(partkey: str, extra: str = "0") -> str:
    digits = f"reverse(CAST({partkey} + 10000 AS VARCHAR))"
    check = f"list_sum(list_transform(string_split({digits}, ''), lambda d, i: i * CAST(d AS INT)))"
    number = f"({partkey} + 10000)"
    return (
        f"concat({number} // 100, '-', lpad(CAST({number} % 100 AS VARCHAR), 2, '0'), '-', "
        f"(CAST({check} AS BIGINT) + {extra}) % 10)"
    )


_LAST_WINS = "row_number() OVER (PARTITION BY key ORDER BY (part <> 0) DESC, part, row DESC) = 1"
_INCHIKEY = "upper(substr(md5(concat(p_name, '/', p_size)), 1, 14))"
_IUPAC = "concat(p_name, ' ', p_size, ' ', p_brand)"
_TAGS = r"""</?[a-zA-Z0-9"'',=-]+/?>"""

# Mentions

_cte("lines", [], f"""
    SELECT concat('L', row_number() OVER ()) AS doc, l_orderkey, [
        {_cas_word('l_partkey', 'CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END')},
        concat('Supplier#', lpad(CAST(l_suppkey AS VARCHAR), 9, '0'))] AS ws
    FROM lineitem""")
_cte("part_words", [], f"""
    SELECT p_partkey, [
        concat('O<sub>', p_partkey % 7 + 2, '</sub>Fe₂(NH)', p_size % 3 + 2, 'Na'),
        concat('Na Fe2(HN)', p_size % 3 + 2, 'O', p_partkey % 7 + 2),
        concat('FeO1-', p_partkey % 7 + 2),
        concat('Fe0.', lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0'), 'O'),
        concat(p_partkey % 7 + 2, '(KCl)', p_size % 3 + 2, '(I)Br'),
        {_strings(REJECTED_FORMULAS)}[p_partkey % {len(REJECTED_FORMULAS)} + 1],
        {_IUPAC}] AS ws
    FROM part""")
# The lines of an order share their patent_id; doc tells documents apart.
_cte("documents_", ["lines", "part_words"], """
    SELECT concat('D', doc_id) AS doc, doc AS patent_id, string_split(text, ' ') AS ws FROM documents
    UNION ALL SELECT doc, concat('O', l_orderkey), ws FROM lines
    UNION ALL SELECT concat('P', p_partkey) AS doc, doc, ws FROM part_words
    UNION ALL SELECT concat('C', o_orderkey) AS doc, doc,
                     [concat('Customer#', lpad(CAST(o_custkey AS VARCHAR), 9, '0'))] FROM orders""")
_cte("mentions", ["documents_"], """
    SELECT doc, patent_id, pos, pos AS start_orig, CAST(pos + length(word_orig) AS INTEGER) AS end_orig, word_orig
    FROM (SELECT doc, patent_id, CAST(generate_subscripts(ws, 1) - 1 AS INTEGER) AS pos, unnest(ws) AS word_orig FROM documents_)""")
_cte("words", ["mentions"], "SELECT DISTINCT word_orig FROM mentions")

# Recogniser output

_cte("ner_lines", [], """
    SELECT doc_id, generate_subscripts(ls, 1) AS line_no, unnest(ls) AS line
    FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)""")
_cte("ner_words", ["ner_lines"], """
    SELECT doc_id, line_no, CAST(generate_subscripts(ws, 1) - 1 AS INTEGER) AS place, unnest(ws) AS word_orig
    FROM (SELECT doc_id, line_no, string_split(line, ' ') AS ws FROM ner_lines)""")
_cte("ner", ["ner_words"], """
    SELECT CAST(doc_id AS VARCHAR) AS patent_id,
           CAST(row_number() OVER (PARTITION BY doc_id ORDER BY line_no, place) - 1 AS INTEGER) AS pos,
           place AS start_orig, CAST(place + length(word_orig) AS INTEGER) AS end_orig, word_orig
    FROM ner_words WHERE regexp_matches(word_orig, '^[A-Z]')""")
_NER = "SELECT patent_id, pos, start_orig, end_orig, word_orig FROM ner"

_cte("files", [], """
    SELECT concat('ner_part_', o_orderkey, '.json.gz') AS file, CAST(o_orderkey AS VARCHAR) AS part FROM orders
    UNION ALL SELECT concat('alt_part_', o_orderkey, '.json.gz'), CAST(o_orderkey AS VARCHAR) FROM orders
    WHERE o_orderpriority = '1-URGENT'
    UNION ALL SELECT concat('stray_', o_orderkey, '.json.gz'), NULL FROM orders WHERE o_orderpriority = '5-LOW'""")

# Predicates and simple keys

_cte("judged", ["words"], r"""
    SELECT word_orig, CASE
        WHEN length(word_orig) = 1 THEN 'single_char'
        WHEN regexp_full_match(word_orig, '([-,''\[\]])?[N\d)(\[\]-]+([-.,''\[\]])?[N,\d)(\[\]-]*?') THEN 'digits'
        WHEN word_orig IN ('SUS304', 'PVAc') THEN 'caps'
        WHEN regexp_full_match(word_orig, '[A-Z]+s?') AND word_orig NOT IN (
            'PE', 'PEEK', 'NAFION', 'PEDT', 'KAPTON', 'MYLAR', 'CO', 'WC', 'KOH', 'HCN', 'WO', 'KCN') THEN 'caps'
        END AS reason
    FROM words""")


def _cas_key(word: str) -> str:
    plain = f"replace({word}, '-', '')"
    body = f"string_split(reverse({plain}), '')[2:]"
    total = f"list_sum(list_transform({body}, lambda c, i: i * CAST(c AS INT)))"
    return (
        rf"CASE WHEN regexp_full_match({word}, '\d{{2,7}}-\d{{2}}-\d') THEN "
        f"CASE WHEN {total} % 10 = CAST(right({plain}, 1) AS INT) THEN CAST({plain} AS BIGINT) END END"
    )


_cte("cas_keys", ["words"], f"SELECT word_orig, {_cas_key('word_orig')} AS key FROM words")

# Formula parser

_BRACKET = r"\(([A-Za-z]+)\)([0-9]+)"
_NUMBER = r"[0-9]+(\.[0-9]+)?"
_AMOUNT = r"\s*\+?([0-9]+\.?[0-9]*|\.[0-9]+)\s*"

_cte("cleaned", ["words"], r"""
    SELECT word_orig, translate(
        regexp_replace(
            regexp_replace(
                regexp_replace(replace(word_orig, ' ', ''), '</?sub>([0-9])', '\1', 'g'),
                '([0-9])</?sub>', '\1', 'g'),
            '\(I+\)', '', 'g'),
        '₀₁₂₃₄₅₆₇₈₉—═', '0123456789-=') AS cleaned
    FROM words""")
_cte("rounds", ["cleaned"], f"""
    SELECT word_orig, cleaned AS expanded FROM cleaned
    UNION ALL
    SELECT word_orig, CASE WHEN length(digits) <= 3
        THEN replace(expanded, found, repeat(letters, CAST(digits AS BIGINT))) END
    FROM (SELECT word_orig, expanded,
                 regexp_extract(expanded, '{_BRACKET}', 0) AS found,
                 regexp_extract(expanded, '{_BRACKET}', 1) AS letters,
                 regexp_extract(expanded, '{_BRACKET}', 2) AS digits
          FROM rounds)
    WHERE found <> ''""")
_cte("expanded", ["cleaned", "rounds"], f"""
    SELECT word_orig, cleaned, expanded
    FROM rounds JOIN cleaned USING (word_orig)
    WHERE expanded IS NULL OR NOT regexp_matches(expanded, '{_BRACKET}')""")
_cte("runs", ["expanded"], r"""
    SELECT word_orig, cleaned, expanded, list_transform(
        regexp_extract_all(expanded, '\p{L}+|\P{L}+'),
        lambda r: regexp_replace(r, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')) AS runs
    FROM expanded""")
_cte("tokenised", ["runs"], rf"""
    SELECT word_orig, cleaned, expanded, flatten(list_transform(runs, lambda r: CASE
        WHEN regexp_matches(r, '^\p{{L}}') AND NOT regexp_matches(r, '[\p{{Lu}}\p{{Ll}}]') THEN ['']
        WHEN regexp_matches(r, '^\p{{L}}') THEN regexp_extract_all(
            regexp_replace(r, '[^\p{{Lu}}\p{{Ll}}]', '', 'g'), '\p{{Ll}}+(?:\p{{Lu}}\p{{Ll}}*)?|\p{{Lu}}\p{{Ll}}*')
        WHEN regexp_full_match(r, '{_NUMBER}') OR contains(r, '-') THEN [r]
        ELSE [] END)) AS tokens
    FROM runs""")
_cte("tokens", ["tokenised"], rf"""
    SELECT word_orig, token, i, n, regexp_full_match(token, '{_NUMBER}') AS is_number,
           regexp_full_match(token, '{_AMOUNT}(-{_AMOUNT})*') AS is_amount,
           CASE WHEN is_amount THEN CAST(string_split(token, '-')[1] AS DOUBLE) END AS lo,
           CASE WHEN is_amount THEN CAST(string_split(token, '-')[-1] AS DOUBLE) END AS hi
    FROM (SELECT word_orig, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS i, len(tokens) AS n
          FROM tokenised)""")
_cte("following", ["tokens"], """
    SELECT *, lead(token) OVER w AS next_token, lead(is_amount) OVER w AS next_amount,
           lead(lo) OVER w AS next_lo, lead(hi) OVER w AS next_hi,
           first_value(lo) OVER w AS lead_lo, first_value(hi) OVER w AS lead_hi
    FROM tokens WINDOW w AS (PARTITION BY word_orig ORDER BY i)""")
_cte("list_flaws", ["following"], """
    SELECT word_orig,
           bool_or(i = n AND token IN ('0', '1')) AS ends_low,
           bool_or(token = next_token AND token <> 'O') AS repeats,
           bool_or(n = 2 AND i = 2 AND is_number AND lo < 50) AND bool_or(i = 1 AND token = 'C') AS few_carbons,
           bool_or(is_number AND lo >= 100) AS too_many
    FROM following GROUP BY word_orig""")
_cte("rejected", ["tokenised", "list_flaws"], r"""
    SELECT word_orig, CASE
        WHEN regexp_matches(cleaned, '[/><,≡=×]') THEN 'symbol'
        WHEN expanded IS NULL THEN 'expansion'
        WHEN left(expanded, 1) IN (':', ')') OR right(expanded, 1) IN (':', '(') OR right(expanded, 2) = 'Ac' THEN 'edge'
        WHEN len(string_split(expanded, '(')) <> len(string_split(expanded, ')')) THEN 'brackets'
        WHEN len(tokens) = 0 THEN 'empty'
        WHEN ends_low THEN 'last'
        WHEN repeats THEN 'repeat'
        WHEN few_carbons THEN 'carbon'
        WHEN too_many THEN 'large'
        END AS reason
    FROM tokenised LEFT JOIN list_flaws USING (word_orig)""")
_cte("elements", [], f"""
    SELECT unnest(s) AS token, generate_subscripts(s, 1) AS z FROM (SELECT {_strings(SYMBOLS)} AS s)""")
_cte("amounts", ["following", "rejected", "elements"], """
    SELECT word_orig, z,
           CASE WHEN lead_lo IS NULL THEN 1.0::DOUBLE WHEN lead_lo = lead_hi THEN lead_lo
                WHEN lead_hi = 0 THEN 0.0::DOUBLE ELSE lead_lo / lead_hi END AS factor,
           factor * (CASE WHEN next_amount THEN next_lo ELSE 1.0::DOUBLE END) AS lower,
           factor * (CASE WHEN next_amount THEN next_hi ELSE 1.0::DOUBLE END) AS upper
    FROM following JOIN rejected USING (word_orig) LEFT JOIN elements USING (token)
    WHERE reason IS NULL AND NOT is_amount AND (token <> '' OR coalesce(next_amount, false))""")
_cte("sums", ["amounts"], """
    SELECT word_orig, z, sum(lower) AS lower, sum(upper) AS upper FROM amounts GROUP BY word_orig, z""")
_cte("formula_keys", ["words", "sums"], """
    SELECT word_orig, key FROM words LEFT JOIN (
        SELECT word_orig, CASE WHEN bool_and(z IS NOT NULL) THEN
            string_agg(concat(z, ':', printf('%.2f', lower), ':', printf('%.2f', upper)), '|' ORDER BY z) END AS key
        FROM sums GROUP BY word_orig) USING (word_orig)""")

# Dictionaries

_cte("name_rows", [], f"""
    SELECT regexp_replace(concat('<i>', word, '</i>'), '{_TAGS}', '', 'g') AS key, part, number * 1000000 + pos AS row,
           CASE WHEN word LIKE 'I%' THEN CAST([] AS VARCHAR[]) ELSE [source] END AS ids
    FROM (
        SELECT concat('S', conv_id) AS source, turn AS part, conv_id AS number,
               generate_subscripts(ws, 1) - 1 AS pos, unnest(ws) AS word
        FROM (SELECT *, string_split(text, ' ') AS ws FROM conversations)
        UNION ALL
        SELECT concat('B', item_id), 8, item_id, generate_subscripts(ws, 1) - 1, unnest(ws)
        FROM (SELECT *, string_split(text, ' ') AS ws FROM benchmark))""")
_cte("dict_name", ["name_rows"], f"SELECT key, ids FROM name_rows QUALIFY {_LAST_WINS}")
_cte("dict_cas", [], f"""
    SELECT CAST(replace({_cas_word('p_partkey')}, '-', '') AS BIGINT) AS key, [CAST(p_partkey AS VARCHAR)] AS ids
    FROM part QUALIFY row_number() OVER (PARTITION BY key ORDER BY p_partkey DESC) = 1""")
_cte("formula_rows", [], """
    SELECT p_partkey AS row, 0 AS part, concat(
        '1:', r, '.00:', r, '.00|7:', r, '.00:', r, '.00|8:', o, '.00:', o, '.00|11:1.00:1.00|26:2.00:2.00') AS key
    FROM (SELECT p_partkey, p_partkey % 7 + 2 AS o, p_size % 3 + 2 AS r FROM part)
    UNION ALL
    SELECT p_partkey, 1, concat(p_partkey % 118 + 1, ':1.00:1.00') FROM part
    UNION ALL
    SELECT p_partkey, 2, CASE
        WHEN a = b THEN concat(a, ':1.00:1.00')
        ELSE concat(least(a, b), ':1.00:1.00|', greatest(a, b), ':1.00:1.00') END
    FROM (SELECT p_partkey, p_partkey % 118 + 1 AS a, (p_partkey // 118) % 118 + 1 AS b FROM part)
    UNION ALL
    SELECT p_partkey, 3, concat('8:1.00:', p_partkey % 7 + 2, '.00|26:1.00:1.00') FROM part""")
_cte("dict_formula", ["formula_rows"], f"""
    SELECT key, [concat('F', part, '_', row)] AS ids FROM formula_rows QUALIFY {_LAST_WINS}""")
_cte("dict_inchikey", [], f"""
    SELECT {_INCHIKEY} AS key, [CAST(p_partkey AS VARCHAR)] AS ids
    FROM part QUALIFY row_number() OVER (PARTITION BY key ORDER BY p_partkey DESC) = 1""")
_cte("name_to_inchikey", [], f"""
    SELECT DISTINCT {_IUPAC} AS name, {_INCHIKEY} AS key FROM part WHERE p_name NOT LIKE 'blue%'""")
_cte("dict_entity", [], """
    SELECT c_name AS key, [lpad(CAST(c_custkey AS VARCHAR), 8, '0')] AS ids FROM customer
    UNION ALL SELECT s_name, [concat('S', s_suppkey)] FROM supplier""")

# Lookups

_cte("hit_name", ["words", "dict_name"], """
    SELECT word_orig, ids FROM words JOIN dict_name ON word_orig = key WHERE len(ids) > 0""")
_cte("hit_cas", ["cas_keys", "dict_cas"], "SELECT word_orig, ids FROM cas_keys JOIN dict_cas USING (key)")
_cte("hit_formula", ["formula_keys", "dict_formula"], """
    SELECT word_orig, ids FROM formula_keys JOIN dict_formula USING (key)""")
_cte("hit_inchikey", ["words", "name_to_inchikey", "dict_inchikey"], """
    SELECT word_orig, ids FROM words JOIN name_to_inchikey ON word_orig = name JOIN dict_inchikey USING (key)""")
_cte("hit_entity", ["words", "dict_entity"], "SELECT word_orig, ids FROM words JOIN dict_entity ON word_orig = key")


def _first_hits(kept: str) -> str:
    stages = ["name", "cas", "formula", "inchikey", "entity"]
    joins = " ".join(f"LEFT JOIN hit_{s} AS {s} USING (word_orig)" for s in stages)
    cases = " ".join(f"WHEN {s}.ids IS NOT NULL THEN '{s}'" for s in stages)
    ids = ", ".join(f"{s}.ids" for s in stages)
    return f"""
    SELECT word_orig, reason IS NULL OR cas_keys.key IS NOT NULL AS clean,
           CASE {cases} END AS stage, coalesce({ids}) AS ids
    FROM judged JOIN cas_keys USING (word_orig) {joins} WHERE {kept}"""


_HITS = ["judged", "cas_keys", "hit_name", "hit_cas", "hit_formula", "hit_inchikey", "hit_entity"]
_cte("cascade", _HITS, f"SELECT word_orig, stage, ids FROM ({_first_hits('true')}) WHERE clean")
_cte("cascade_strict", _HITS, _first_hits("reason IS NULL"))
# Rubbish goes, unless the step before the filter, the lookup of names, has resolved it.
_cte("cascade_scoped", _HITS, f"""
    SELECT word_orig, stage, ids FROM ({_first_hits('true')}) WHERE clean OR stage = 'name'""")
_cte("tagged", ["mentions", "cascade"], "SELECT * FROM mentions JOIN cascade USING (word_orig)")
_cte("substances", ["tagged"], "SELECT * FROM tagged WHERE stage <> 'entity'")
_cte("entities", ["tagged"], "SELECT * FROM (SELECT *, unnest(ids) AS ppi_id FROM tagged WHERE stage = 'entity') WHERE length(ppi_id) = 8")

_IDS = "array_to_string(ids, ',') AS ids"


def _per_document(source: str, columns: str) -> str:
    return f"""
        SELECT d.patent_id, {columns} FROM documents_ AS d LEFT JOIN {source} USING (doc) GROUP BY doc, d.patent_id"""


def statements() -> dict[str, str]:
    sql: dict[str, str] = {}

    def add(name: str, needs: list[str], select: str) -> None:
        sql[name] = _with(needs, select)

    add("ner_ingest", ["ner"], _NER)
    add("ner_ingest_stream", ["ner"], _NER)
    add("ner_quarantine", [], """SELECT concat('{"patent_id": "L', doc_id, '", "data') AS bad_line FROM labels WHERE toxic = 1""")
    add("ingest_counts", ["ner"], """
        SELECT (SELECT count(*) FROM documents) AS n_docs, (SELECT count(*) FROM ner) AS n_mentions,
               (SELECT count(*) FROM documents WHERE CAST(doc_id AS VARCHAR) NOT IN (SELECT patent_id FROM ner)) AS n_empty_docs,
               (SELECT count(*) FROM labels WHERE toxic = 1) AS n_bad_lines""")
    add("mentions_flat", ["mentions"], "SELECT patent_id, pos, start_orig, end_orig, word_orig FROM mentions")
    add("part_id", ["files"], "SELECT file, part FROM files")
    add("pending_files", ["files"], """
        SELECT file FROM files WHERE part IS NOT NULL AND file NOT IN (
            SELECT concat('ner_part_', o_orderkey, '.json.gz') FROM orders WHERE o_orderstatus = 'F')""")
    add("batch_assign", ["files"], f"""
        SELECT file, (row_number() OVER (ORDER BY md5(file), file) - 1) // {BATCH_SIZE} AS batch_id FROM files""")
    add("compact", ["documents_"], """
        SELECT patent_id, CAST(len(ws) AS INTEGER) AS n FROM documents_
        UNION ALL SELECT patent_id, CAST(len(ws) AS INTEGER) FROM documents_ WHERE patent_id LIKE 'D%'""")
    add("bucketed_roundtrip", ["documents_"], "SELECT patent_id, CAST(len(ws) AS INTEGER) AS n FROM documents_")

    add("rubbish_reasons", ["judged"], "SELECT word_orig, reason FROM judged")
    add("rubbish_filter", ["mentions", "judged"], """
        SELECT patent_id, CAST(count(*) FILTER (reason IS NULL) AS INTEGER) AS kept, CAST(count(reason) AS INTEGER) AS dropped
        FROM mentions JOIN judged USING (word_orig) GROUP BY doc, patent_id""")
    add("strip_tags", [], f"""
        SELECT page_id, md5(regexp_replace(nullif(html, ''), '{_TAGS}', '', 'g')) AS text_md5 FROM pages""")
    add("cas_key", [], f"""
        SELECT l_orderkey, l_linenumber, {_cas_key('word')} AS cas FROM (
            SELECT l_orderkey, l_linenumber,
                   {_cas_word('l_partkey', 'CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END')} AS word FROM lineitem)""")
    add("formula_clean", ["cleaned"], "SELECT word_orig, cleaned FROM cleaned")
    add("formula_expand", ["expanded"], "SELECT word_orig, expanded FROM expanded")
    add("formula_tokens", ["tokenised"], """
        SELECT word_orig, CASE WHEN expanded IS NOT NULL THEN array_to_string(tokens, ' ') END AS tokens FROM tokenised""")
    add("formula_rejects", ["rejected"], "SELECT word_orig, reason FROM rejected")
    add("formula_key", ["formula_keys"], "SELECT word_orig, key FROM formula_keys")

    for name in ("name", "cas", "formula", "inchikey", "entity"):
        add(f"dict_{name}", [f"dict_{name}"], f"SELECT key, {_IDS} FROM dict_{name}")
        add(f"lookup_{name}", [f"hit_{name}"], f"SELECT word_orig, {_IDS} FROM hit_{name}")
    sql["dict_name_bucketed"] = sql["dict_name"]
    add("dict_merge_union", ["name_rows"], "SELECT DISTINCT key, unnest(ids) AS id FROM name_rows")

    add("cascade", ["cascade"], f"SELECT word_orig, stage, {_IDS}, '{SECTION}' AS section FROM cascade")
    add("cascade_keep_names", ["cascade_scoped"], f"""
        SELECT word_orig, stage, {_IDS}, '{SECTION}' AS section FROM cascade_scoped""")
    add("tagged_keep_names", ["mentions", "cascade_scoped"], f"""
        SELECT patent_id, pos, word_orig, {_IDS}, stage FROM mentions JOIN cascade_scoped USING (word_orig)""")
    add("cascade_extended", ["cascade"], f"SELECT word_orig, stage, {_IDS} FROM cascade")
    add("cascade_drop_cas", ["cascade_strict"], f"""
        SELECT word_orig, stage, {_IDS}, '{SECTION}' AS section FROM cascade_strict""")
    add("tagged_mentions", ["tagged"], f"""
        SELECT patent_id, pos, word_orig, {_IDS}, stage, '{SECTION}' AS section FROM tagged""")
    add("resolved_only", ["tagged"], f"SELECT patent_id, pos, word_orig, {_IDS} FROM tagged WHERE stage IS NOT NULL")
    add("route_substance", ["substances"], f"SELECT patent_id, pos, word_orig, {_IDS} FROM substances")
    add("route_entity", ["entities"], "SELECT patent_id, pos, word_orig, ppi_id FROM entities")
    add("publish_substance", ["documents_", "substances"], _per_document("substances", """
        CAST(count(pos) AS INTEGER) AS n, md5(coalesce(string_agg(array_to_string(ids, ','), ',' ORDER BY pos), '')) AS ids_md5"""))
    add("publish_entity", ["documents_", "entities"], _per_document("entities", """
        CAST(count(pos) AS INTEGER) AS n, coalesce(string_agg(ppi_id, ',' ORDER BY pos), '') AS ids"""))
    add("link_documents", ["documents_", "substances", "entities"], f"""
        SELECT 'substance' AS output, * FROM ({_per_document("substances", "CAST(count(pos) AS INTEGER) AS n")})
        UNION ALL SELECT 'entity', * FROM ({_per_document("entities", "CAST(count(pos) AS INTEGER) AS n")})""")
    add("renest", ["documents_", "mentions", "judged"], _per_document(
        "(SELECT * FROM mentions JOIN judged USING (word_orig) WHERE reason IS NULL)", """
        CAST(count(pos) AS INTEGER) AS n, md5(coalesce(string_agg(word_orig, '|' ORDER BY pos), '')) AS words_md5"""))
    add("nested_resolved_only", ["documents_", "tagged"], _per_document("tagged", "CAST(count(stage) AS INTEGER) AS n"))

    sql["compact_versions"], sql["dict_upkeep"], sql["resolve_stream"] = sql["compact"], sql["dict_name"], sql["tagged_mentions"]
    of_batch = f"(instr('{PARTS}', left(patent_id, 1)) - 1) // 2"
    add("batch_outputs", ["substances", "entities"], " UNION ALL ".join(f"""
        SELECT '{name}' AS output, CAST({of_batch} AS INTEGER) AS batch_id,
               CASE WHEN {of_batch} = 1 THEN 'again' ELSE '{SECTION}' END AS section, count(*) AS n
        FROM {table} GROUP BY ALL""" for name, table in (("substance", "substances"), ("entity", "entities"))))
    inner = "data.results_list.infer_list."
    add("schema_drift", [], f"""
        SELECT file, field, declared, kind, drift, count(kind) AS n
        FROM (VALUES
            ('kept', '{inner}word', NULL, 'string', 'unknown', 0), ('changed', '{inner}word', NULL, 'string', 'unknown', 1),
            ('changed', '{inner}label', NULL, 'string', 'unknown', 1),
            ('changed', '{inner}entity_group', 'string', NULL, 'missing', 1),
            ('changed', '{inner}start_orig', 'int', 'string', 'retyped', 1)) AS f(file, field, declared, kind, drift, odd)
        JOIN documents ON doc_id % 2 = odd GROUP BY file, field, declared, kind, drift""")

    add("resolver_failing", ["words"], """
        SELECT word_orig,
               CASE WHEN contains(word_orig, ' ') AND NOT starts_with(word_orig, 'blue')
                    THEN upper(substr(md5(word_orig), 1, 14)) END AS key,
               CASE WHEN starts_with(word_orig, 'blue') THEN concat('ValueError: ', word_orig) END AS error
        FROM words""")
    add("resolver_quarantine", ["words"], f"""
        SELECT word_orig, 'resolver' AS stage FROM words SEMI JOIN part ON word_orig = {_IUPAC}
        WHERE NOT starts_with(word_orig, 'blue')
        UNION ALL SELECT word_orig, 'quarantine' FROM words WHERE starts_with(word_orig, 'blue')""")
    add("custom_stage", ["words", "dict_name"], f"""
        SELECT word_orig, 'lower' AS stage, {_IDS} FROM words JOIN dict_name ON lower(word_orig) = key
        WHERE len(ids) > 0""")
    add("lookup_union", ["words", "name_rows"], f"""
        SELECT word_orig, {_IDS} FROM words JOIN (
            SELECT key, list_sort(list(DISTINCT id)) AS ids
            FROM (SELECT key, unnest(ids) AS id FROM name_rows) GROUP BY key) ON key = word_orig""")
    add("custom_resolver", ["words", "hit_name"], """
        SELECT word_orig, upper(substr(md5(word_orig), 1, 14)) AS key FROM words ANTI JOIN hit_name USING (word_orig)
        WHERE contains(word_orig, ' ')""")
    add("custom_resolver_chain", ["words", "hit_name", "hit_entity"], f"""
        SELECT word_orig, stage, {_IDS} FROM (
            SELECT word_orig, 'name' AS stage, ids FROM hit_name
            UNION ALL
            SELECT word_orig, 'resolver', [CAST(max(p_partkey) AS VARCHAR)]
            FROM words JOIN part ON word_orig = {_IUPAC} ANTI JOIN hit_name USING (word_orig) GROUP BY word_orig
            UNION ALL
            SELECT word_orig, 'entity', ids FROM hit_entity ANTI JOIN hit_name USING (word_orig))""")
    return sql
