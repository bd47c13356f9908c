"""SQL equivalents of the registered queries, for DuckDB over the same tables.

Shared steps are common table expressions, pulled in by name. Queries that need a stemmer or an
HTML tree have no entry.
"""

from __future__ import annotations

from rankloom.functions import scoring as sc
from rankloom.functions import text as tx
from rankloom.functions import urls
from rankloom.operators import requests as rq
from rankloom.plans import views as v

_P, _B = sc.SearchParams(), sc.BooleanParams()


def _list(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


_STOP = _list(tx.STOP_WORDS)
_STANDARD_STOP = _list(tx.STANDARD_STOP_WORDS)
_DELIMITERS = r"[ \t\n\r\f]"
_URL = r"^([A-Za-z][A-Za-z0-9+.-]*)://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^?#]*)(\?[^#]*)?(?:#.*)?$"
_TRIM = r"'^[\x00-\x20]+|[\x00-\x20]+$'"


def _trim(text: str) -> str:
    return f"regexp_replace({text}, {_TRIM}, '', 'g')"


def _split_tokens(text: str) -> str:
    bare = rf"regexp_replace(lower({text}), '^{_DELIMITERS}+|{_DELIMITERS}+$', '', 'g')"
    return f"CASE WHEN {bare} = '' THEN []::VARCHAR[] ELSE regexp_split_to_array({bare}, '{_DELIMITERS}+') END"


# Marks inside words and numbers, each with a private character that stands for it.
_MARKS = ".:'\u00b7\u2018\u2019,;"
_PRIVATE = "".join(chr(0xE000 + i) for i in range(len(_MARKS)))


def _joined_marks(text: str) -> str:
    """Put private characters for marks between letters or digits: there is no look-around. Twice, as matches can't overlap."""
    for kind, marks in ((r"[\p{L}\p{M}]", ".:'\u00b7\u2018\u2019"), (r"\p{Nd}", ".,;'\u2018\u2019")):
        for mark in marks + marks:
            private = _PRIVATE[_MARKS.index(mark)]
            text = rf"regexp_replace({text}, '({kind})[{mark.replace(chr(39), chr(39) * 2)}]({kind})', '\1{private}\2', 'g')"
    return text


def _words(text: str) -> str:
    return f"list_filter(list_transform(string_split({text}, ' '), lambda w: {_trim('w')}), lambda w: w <> '')"


def _kept_words(text: str) -> str:
    return f"list_filter({_words(text)}, lambda w: w NOT IN ({_STOP}))"


def _without_tail(parts: str) -> str:
    """Drop trailing empty strings of a list with more than one element."""
    filled = f"list_max(list_filter(list_transform({parts}, lambda p, i: CASE WHEN p <> '' THEN i END), lambda i: i IS NOT NULL))"
    return f"CASE WHEN len({parts}) = 1 THEN {parts} ELSE {parts}[1:coalesce({filled}, 0)] END"


def _highlight(text: str, words: str, tag: str) -> str:
    """Fixed words, none of which can overlap another in part."""
    return rf"regexp_replace({text}, '(?i)(?:{'|'.join(sorted(words.split(), key=len, reverse=True))})+', '<{tag}>\0</{tag}>', 'g')"


def _case(column: str, values: dict[int, float]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {n} THEN {x!r}::DOUBLE" for n, x in values.items()) + " END"


def _boost(name: str) -> str:
    return _case("field_id", {n: getattr(b, name) for n, b in _P.boosts.items()})


def _clause_boost(name: str) -> str:
    return _case("field_id", {n: getattr(b, name) for n, b in _B.boosts.items()})


def _url(column: str, part: int) -> str:
    return f"regexp_extract({column}, '{_URL}', {part})"


def _query_values() -> str:
    return ", ".join(f"({i}, '{raw}')" for i, raw in v.QUERIES)


_PAGE_STAMP = "'%Y-%m-%d %H:%M'"


_FOLD = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _marked(text: str, words: str, tag: str) -> str:
    """Tags around what a column of query words covers in a text: each word masks its matches, masks are laid over one another."""
    low = f"translate({text}, {_FOLD})"
    found = f"list_filter(list_distinct({words}), lambda w: contains({low}, w))"
    masks = f"list_transform({found}, lambda w: replace({low}, w, repeat(chr(65535), length(w))))"
    on = f"list_transform(range(1, length({text}) + 1), lambda i: len(list_filter({masks}, lambda m: m[i] = chr(65535))) > 0)"
    return (f"CASE WHEN {text} = '' OR len({found}) = 0 THEN {text} ELSE list_reduce(list_prepend('', list_transform(list_zip(string_split({text}, ''), {on}, list_prepend(false, {on})), "
            f"lambda z, i: CASE WHEN coalesce(z[2], false) AND NOT z[3] THEN '<{tag}>' WHEN z[3] AND NOT coalesce(z[2], false) THEN '</{tag}>' ELSE '' END || coalesce(z[1], ''))), lambda x, y: x || y) END")


_LINE = rf"regexp_replace(regexp_replace({_marked('s', 'kw', 'b')}, '\r\n|\r|\n', ' ', 'g'), '[ ]+', ' ', 'g')"
_PAGE, _CATEGORY = f"'{urls.PAGE_BASE}'", f"'{urls.CATEGORY_BASE}'"

CTE: dict[str, tuple[tuple[str, ...], str]] = {
    "raw_pages": ((), """
        SELECT doc_id AS arrival, trim(split_part(text, chr(10), 1)) AS title,
            CASE WHEN position(chr(10) IN text) > 0 THEN substr(text, position(chr(10) IN text) + 1) ELSE '' END AS content,
            [source, lang] AS categories, TIMESTAMP '2018-01-01 00:00:00' + to_minutes(doc_id % 1000000) AS last_modify
        FROM documents"""),
    "unique_pages": (("raw_pages",), """
        SELECT * FROM raw_pages QUALIFY row_number() OVER (PARTITION BY title ORDER BY arrival) = 1"""),
    "wiki_pages": (("raw_pages",), """
        SELECT row_number() OVER (ORDER BY title) - 1 AS doc_id, * FROM (SELECT * FROM raw_pages WHERE title <> '' AND content <> ''
            QUALIFY row_number() OVER (PARTITION BY title ORDER BY arrival) = 1)"""),
    "fields": (("wiki_pages",), """
        SELECT doc_id, 0 AS field_id, title AS text FROM wiki_pages
        UNION ALL SELECT doc_id, 1, content FROM wiki_pages
        UNION ALL SELECT doc_id, 2, array_to_string(categories, ' ') FROM wiki_pages"""),
    "token_lists": (("fields",), f"""
        SELECT doc_id, field_id, {_split_tokens('text')} AS tokens FROM fields"""),
    "tokens": (("token_lists",), """
        SELECT doc_id, field_id, len(tokens)::INTEGER AS doc_len, unnest(tokens) AS token,
            generate_subscripts(tokens, 1) - 1 AS pos FROM token_lists"""),
    "all_words": (("tokens",), f"""
        SELECT doc_id, field_id, doc_len, pos, term FROM (
            SELECT *, {_trim("regexp_replace(token, '^[[:punct:]]+|[[:punct:]]+$', '', 'g')")} AS term FROM tokens)
        WHERE regexp_full_match(term, '[A-Za-z0-9]+')"""),
    "words": (("all_words",), f"SELECT * FROM all_words WHERE term NOT IN ({_STOP})"),
    "postings": (("words",), """
        SELECT term, field_id, doc_id, count(*)::INTEGER AS tf, list(pos ORDER BY pos) AS positions, doc_len
        FROM words GROUP BY term, field_id, doc_id, doc_len"""),
    "term_stats": (("postings",), "SELECT term, field_id, count(*) AS df FROM postings GROUP BY ALL"),
    "doc_lengths": (("token_lists",), "SELECT doc_id, field_id, len(tokens) AS len FROM token_lists"),
    "field_stats": (("doc_lengths",), """
        SELECT field_id, sum(len)::BIGINT AS total_len, count(*) AS n_docs, sum(len) / count(*) AS avg_len
        FROM doc_lengths GROUP BY field_id"""),
    "posting_entries": (("postings",), """
        SELECT term, doc_id,
            [coalesce(max(tf) FILTER (field_id = 0), 0), coalesce(max(tf) FILTER (field_id = 1), 0),
             coalesce(max(tf) FILTER (field_id = 2), 0)] AS tf,
            flatten(list(positions ORDER BY field_id)) AS positions
        FROM postings GROUP BY term, doc_id"""),
    "std_lists": (("fields",), rf"""
        SELECT doc_id, field_id, flatten(list_transform(list_filter(regexp_extract_all(marked, '[\p{{L}}\p{{M}}\p{{N}}_{_PRIVATE}]+'),
                lambda w: regexp_matches(w, '[\p{{L}}\p{{N}}]')),
            lambda w: regexp_extract_all(translate(w, '{_PRIVATE}', '{_MARKS.replace("'", "''")}'), '(?s).{{1,255}}'))) AS tokens
        FROM (SELECT doc_id, field_id, {_joined_marks('lower(text)')} AS marked FROM fields)"""),
    "std_words": (("std_lists",), f"""
        SELECT doc_id, field_id, pos, term, count(*) OVER (PARTITION BY doc_id, field_id)::INTEGER AS doc_len FROM (
            SELECT doc_id, field_id, unnest(tokens) AS term, generate_subscripts(tokens, 1) - 1 AS pos FROM std_lists)
        WHERE term <> '' AND term NOT IN ({_STANDARD_STOP})"""),
    "std_postings": (("std_words",), """
        SELECT term, field_id, doc_id, count(*)::INTEGER AS tf, list(pos ORDER BY pos) AS positions, doc_len
        FROM std_words GROUP BY term, field_id, doc_id, doc_len"""),
    "std_stats": (("std_postings",), "SELECT term, field_id, count(*) AS df FROM std_postings GROUP BY ALL"),
    "std_fields": (("std_words",), """
        SELECT field_id, sum(len) / count(*) AS avg_len, count(*) AS n_docs FROM (
            SELECT doc_id, field_id, count(*) AS len FROM std_words GROUP BY ALL) GROUP BY field_id"""),
    "doc_links": (("wiki_pages",), """
        SELECT src, t.doc_id AS dst, pos FROM (
            SELECT src, line, min(i) AS pos FROM (
                SELECT doc_id AS src, trim(unnest(string_split(content, chr(10)))) AS line,
                    generate_subscripts(string_split(content, chr(10)), 1) AS i FROM wiki_pages)
            WHERE line <> '' GROUP BY src, line) JOIN wiki_pages t ON t.title = line"""),
    "part_links": ((), "SELECT DISTINCT l_partkey AS src, l_orderkey AS dst FROM lineitem"),
    "supplier_links": ((), "SELECT DISTINCT l_partkey AS src, l_suppkey AS dst FROM lineitem"),
    # --- queries
    "q": ((), f"SELECT query_id::BIGINT AS query_id, raw FROM (VALUES {_query_values()}) t(query_id, raw)"),
    "split": (("q",), f"""
        SELECT query_id, raw,
            lower(CASE WHEN mark > 0 THEN {_trim('substr(raw, 1, mark - 1)')} ELSE raw END) AS keyword,
            lower(CASE WHEN mark > 0 THEN {_trim('substr(raw, mark + 9)')} ELSE '' END) AS category
        FROM (SELECT *, position('category:' IN raw) AS mark FROM q)"""),
    "clauses": (("split",), f"""
        SELECT query_id, 'keyword' AS clause, {_kept_words('keyword')} AS words FROM split
        UNION ALL SELECT query_id, 'category', {_kept_words('category')} FROM split"""),
    "std_clauses": (("split",), f"""
        SELECT query_id, 'keyword' AS clause, {_words('keyword')} AS words FROM split
        UNION ALL SELECT query_id, 'category', {_words('category')} FROM split"""),
    "clause_fields": ((), "SELECT * FROM (VALUES ('keyword', 0), ('keyword', 1), ('category', 2)) t(clause, field_id)"),
}


def _slots(clauses: str) -> str:
    return f"""
        SELECT query_id, clause, slot, term, len(list_filter(words, lambda w: w = term)) AS qf,
            list_position(words, term) = slot + 1 AS is_first, len(words) AS n_terms, len(list_distinct(words)) AS n_distinct
        FROM (SELECT *, unnest(words) AS term, generate_subscripts(words, 1) - 1 AS slot FROM {clauses})"""


CTE |= {
    "slots": (("clauses",), _slots("clauses")),
    "std_slots": (("std_clauses",), _slots("std_clauses")),
    "hits": (("slots", "clause_fields", "postings", "term_stats", "field_stats"), """
        SELECT s.*, p.field_id, p.doc_id, p.tf, p.positions, p.doc_len, t.df, f.avg_len, f.n_docs
        FROM slots s JOIN clause_fields USING (clause) JOIN postings p USING (term, field_id)
        JOIN term_stats t USING (term, field_id) JOIN field_stats f USING (field_id) WHERE p.tf > 0"""),
    "scored": (("hits",), f"""
        SELECT *, ln((n_docs - df + 0.5) / (df + 0.5))
            + ln(({_P.k1} + 1) * tf / ({_P.k1} * ((1 - {_P.b}) + {_P.b} * doc_len / avg_len) + tf))
            + ln(({_P.k2} + 1) * qf / ({_P.k2} + qf)) AS score FROM hits"""),
    "coverage": (("scored",), """
        SELECT query_id, clause, field_id, doc_id, n_terms, n_distinct, doc_len,
            sum(score) FILTER (is_first) AS raw, count(*) FILTER (is_first)::INTEGER AS n_matched
        FROM scored GROUP BY ALL"""),
    "pairs": (("hits",), """
        SELECT a.query_id, a.clause, a.field_id, a.doc_id, count(*) AS n FROM hits a JOIN hits b
            ON a.query_id = b.query_id AND a.clause = b.clause AND a.field_id = b.field_id AND a.doc_id = b.doc_id
            AND b.slot = a.slot + 1
        WHERE list_has_any(list_transform(a.positions, lambda p: p + 1), b.positions) GROUP BY ALL"""),
    "matched": (("coverage", "pairs"), """
        SELECT c.*, CASE WHEN n_matched = n_distinct THEN coalesce(p.n, 0)::INTEGER END AS n_adjacent
        FROM coverage c LEFT JOIN pairs p USING (query_id, clause, field_id, doc_id)"""),
    "field_scored": (("matched",), f"""
        SELECT *, raw * CASE match WHEN 'exact' THEN {_boost('exact')} WHEN 'order' THEN {_boost('order')}
            WHEN 'all' THEN {_boost('all_terms')} ELSE {_boost('partial')} END * {_boost('field')} AS score
        FROM (SELECT *, CASE WHEN n_matched < n_distinct THEN 'partial' WHEN n_adjacent < n_terms - 1 THEN 'all'
            WHEN doc_len = n_terms THEN 'exact' ELSE 'order' END AS match FROM matched)"""),
    "wide": (("field_scored", "split"), """
        SELECT query_id, doc_id, title, content, cat, coalesce(title, 0) + coalesce(content, 0) + coalesce(cat, 0) AS text
        FROM (SELECT query_id, doc_id, max(score) FILTER (field_id = 0) AS title,
            max(score) FILTER (field_id = 1) AS content, max(score) FILTER (field_id = 2) AS cat
            FROM field_scored GROUP BY ALL) JOIN split s USING (query_id) WHERE s.category = '' OR cat IS NOT NULL"""),
    "combined": (("wide",), "SELECT * FROM wide WHERE title IS NOT NULL AND content IS NOT NULL"),
    "hit_counts": (("combined", "split"), """
        SELECT query_id, count(doc_id) AS hits FROM split LEFT JOIN combined USING (query_id) GROUP BY query_id"""),
    "normalised": (("combined",), """
        SELECT query_id, doc_id, CASE WHEN low = high THEN 100.0 ELSE (text - low) / (high - low) * 100 END AS text FROM (
            SELECT *, min(text) OVER w AS low, max(text) OVER w AS high FROM combined WINDOW w AS (PARTITION BY query_id))"""),
    "best": (("combined",), """
        SELECT * FROM (SELECT query_id, doc_id, round(text, 9) AS total,
            row_number() OVER (PARTITION BY query_id ORDER BY round(text, 9) DESC, doc_id) AS rn FROM combined) WHERE rn <= 1000"""),
    "paged": (("best",), """
        SELECT * FROM (SELECT b.*, total_pages, greatest(least(query_id - 3, total_pages - 1), 0) AS page FROM best b JOIN (
            SELECT query_id, ceil(count(*) / 10)::INTEGER AS total_pages FROM best GROUP BY query_id) USING (query_id))
        WHERE (rn - 1) // 10 = page"""),
    "std_hits": (("std_slots", "clause_fields", "std_postings", "std_stats", "std_fields"), f"""
        SELECT s.*, p.field_id, p.doc_id, p.positions, p.doc_len, f.avg_len, f.n_docs, p.tf,
            ln(1 + (n_docs - df + 0.5) / (df + 0.5)) AS idf,
            ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf * ({_B.k1} + 1)
                / (tf + {_B.k1} * (1 - {_B.b} + {_B.b} * p.doc_len / avg_len)) AS score
        FROM std_slots s JOIN clause_fields USING (clause) JOIN std_postings p USING (term, field_id)
        JOIN std_stats t USING (term, field_id) JOIN std_fields f USING (field_id)"""),
    "phrases": (("std_hits",), """
        SELECT query_id, clause, field_id, doc_id, count(*)::INTEGER AS phrase_tf FROM (
            SELECT query_id, clause, field_id, doc_id, n_terms, start FROM (
                SELECT query_id, clause, field_id, doc_id, n_terms, slot, unnest(positions) - slot AS start FROM std_hits)
            GROUP BY ALL HAVING count(*) = n_terms) GROUP BY ALL"""),
    "std_clause_scores": (("std_hits", "phrases"), f"""
        SELECT *, (phrase_clause + all_clause + any_clause) * {_clause_boost('field')} AS score FROM (
            SELECT g.*, coalesce(phrase_tf, 0) AS ptf,
                CASE WHEN phrase_tf > 0 THEN idf * phrase_tf * ({_B.k1} + 1)
                    / (phrase_tf + {_B.k1} * (1 - {_B.b} + {_B.b} * doc_len / avg_len)) * {_clause_boost('phrase')} ELSE 0.0 END AS phrase_clause,
                CASE WHEN n_matched = n_terms THEN terms_score * {_clause_boost('all_terms')} ELSE 0.0 END AS all_clause,
                CASE WHEN phrase_tf IS NULL THEN terms_score * {_clause_boost('any_term')} ELSE 0.0 END AS any_clause
            FROM (SELECT query_id, clause, field_id, doc_id, n_terms, doc_len, avg_len, count(*) AS n_matched,
                sum(score) AS terms_score, sum(idf) AS idf FROM std_hits GROUP BY ALL) g
            LEFT JOIN phrases USING (query_id, clause, field_id, doc_id))"""),
    "std_combined": (("std_clause_scores", "split"), """
        SELECT query_id, doc_id, title + content + coalesce(cat, 0) AS text FROM (
            SELECT query_id, doc_id, max(score) FILTER (field_id = 0) AS title,
                max(score) FILTER (field_id = 1) AS content, max(score) FILTER (field_id = 2) AS cat
            FROM std_clause_scores GROUP BY ALL) JOIN split s USING (query_id)
        WHERE title IS NOT NULL AND content IS NOT NULL AND (s.category = '' OR cat IS NOT NULL)"""),
    "shown": (("paged", "split", "wiki_pages"), f"""
        SELECT p.*, printf('%.4f', p.total) AS score, w.title AS raw_title, w.content, w.categories AS raw_categories, w.last_modify,
            {_words('s.keyword')} AS kw, {_words('s.category')} AS cw
        FROM paged p JOIN split s USING (query_id) JOIN wiki_pages w USING (doc_id)"""),
    "snippets": (("shown",), rf"""
        SELECT query_id, doc_id, '... ' || string_agg({_LINE}, ' ... ' ORDER BY best) || ' ...' AS snippet FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id, doc_id ORDER BY list_min(n) * 20 + list_sum(n) DESC, i) AS best FROM (
                SELECT *, list_transform(kw, lambda w: len(regexp_extract_all(s, '(?i)[ ]+' || regexp_escape(w) || '[ ]+'))) AS n FROM (
                    SELECT query_id, doc_id, kw, unnest(parts) AS s, generate_subscripts(parts, 1) AS i FROM (
                        SELECT *, {_without_tail(r"regexp_split_to_array(content, '[,;.\n]')")} AS parts FROM shown))))
        WHERE best <= 5 GROUP BY query_id, doc_id"""),
    "shown_rows": (("shown", "snippets"), f"""
        SELECT query_id, rn, doc_id, {_marked('raw_title', 'kw', 'span')} AS title, raw_title, snippet,
            list_transform(raw_categories, lambda c: {_marked('c', 'cw', 'b')}) AS categories, raw_categories,
            strftime(last_modify, {_PAGE_STAMP}) AS last_modify, score, (page + 1)::INTEGER AS page_no, total_pages
        FROM shown JOIN snippets USING (query_id, doc_id)"""),
    # --- web pages
    "page_links": ((), f"""
        SELECT page_id, link, i, regexp_full_match(link, '{_URL}')
                AND regexp_full_match({_url('link', 2)}, '{v.HOST_PATTERN}') AS is_url FROM (
            SELECT page_id, url AS link, 0 AS i FROM pages UNION ALL
            SELECT page_id, {_url('url', 1)} || '://' || {_url('url', 2)} || unnest(hrefs), generate_subscripts(hrefs, 1) FROM (
                SELECT page_id, url, regexp_extract_all(regexp_extract(html, '(?s)<nav>.*?</nav>'), '<a href="([^"]*)"', 1) AS hrefs
                FROM pages))"""),
    "robots_lines": ((), f"""
        SELECT host, page_id * 3 + n AS line_no, line FROM (
            SELECT page_id, host, unnest([0, 1, 2]) AS n, unnest(['User-agent: ' || CASE lang WHEN 'fr' THEN '*' WHEN 'de' THEN 'other'
                WHEN 'es' THEN 'SITE-*' ELSE 'site-*' END || ' # page', ' disallow: /' || lang || '/' || digit,
                'Allow: /' || lang || '%2F' || length(url)]) AS line FROM (
                SELECT page_id, url, {_url('url', 2)} AS host, regexp_extract({_url('url', 3)}, '^/([a-z]+)/', 1) AS lang,
                    regexp_extract({_url('url', 3)}, '^/[a-z]+/([0-9])', 1) AS digit FROM pages))"""),
    "robots_named": (("robots_lines",), f"""
        SELECT host, line_no, kind, value, last_value(CASE WHEN kind = 'user-agent' THEN {_trim('value')} END IGNORE NULLS)
            OVER (PARTITION BY host ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS agent FROM (
            SELECT host, line_no, lower(regexp_extract({_trim('line')}, '(?i)(User-agent|Allow|Disallow): ([^#]*)', 1)) AS kind,
                regexp_extract({_trim('line')}, '(?i)(User-agent|Allow|Disallow): ([^#]*)', 2) AS value FROM robots_lines)
        WHERE kind <> ''"""),
    "robots_rules": (("robots_named",), f"""
        SELECT host, min(line_no) AS ordinal, path_prefix, max_by(kind = 'allow', line_no) AS allow FROM (
            SELECT *, {_trim('url_decode(value)')} AS path_prefix FROM robots_named
            WHERE kind <> 'user-agent' AND agent IS NOT NULL AND regexp_full_match('{v.AGENT}', replace(replace(agent, '?', '.'), '*', '.*')))
        GROUP BY host, path_prefix"""),
}


def _graph_nodes(graph: str) -> tuple[tuple[str, ...], str]:
    return (graph,), f"""
        SELECT doc_id, deg, (SELECT count(DISTINCT src) FROM {graph}) AS n
        FROM (SELECT src AS doc_id FROM {graph} UNION SELECT dst FROM {graph})
        LEFT JOIN (SELECT src AS doc_id, count(*) AS deg FROM {graph} GROUP BY src) USING (doc_id)"""


def _collect(names, done: dict[str, str]) -> None:
    for name in names:
        if name not in done:
            needs, body = CTE[name]
            _collect(needs, done)
            done[name] = body


def _sql(select: str, *needs: str, extra: dict[str, str] | None = None, recursive: bool = False) -> str:
    done: dict[str, str] = {}
    _collect(needs, done)
    done |= extra or {}
    # Materialised: several of them are read more than once.
    steps = ",\n".join(f"{name} AS MATERIALIZED ({body})" if "(" not in name else f"{name} AS ({body})"
                       for name, body in done.items())
    return f"WITH {'RECURSIVE ' if recursive else ''}{steps}\n{select}" if steps else select


def _rank_sql(select: str, graph: str, rounds: int | None, *needs: str, epsilon: float = 1e-6) -> str:
    """Ranks computed round by round; stops after ``rounds`` or once no node moves by epsilon."""
    more = f"i < {rounds}" if rounds is not None else "NOT done AND i < 200"
    nodes = _graph_nodes(graph)[1]
    ranked = f"""
        SELECT 0, doc_id, CASE WHEN deg IS NULL THEN 0.0 ELSE 1.0 / n END::DOUBLE, deg, n, false FROM nodes
        UNION ALL
        SELECT i, doc_id, rank, deg, n, max(moved) OVER () = 0 FROM (
            SELECT i + 1 AS i, doc_id, new AS rank, deg, n, floor(abs(new - old) * (1 / {epsilon})) AS moved FROM (
                SELECT i, doc_id, deg, n, max(rank) AS old, 0.15 / n + 0.85 * sum(share) AS new FROM (
                    SELECT i, doc_id, deg, n, rank, 0.0 AS share FROM ranked WHERE {more}
                    UNION ALL
                    SELECT r.i, l.dst, t.deg, t.n, NULL, r.rank / r.deg FROM ranked r
                    JOIN {graph} l ON l.src = r.doc_id JOIN nodes t ON t.doc_id = l.dst WHERE {more})
                GROUP BY i, doc_id, deg, n))"""
    extra = {"nodes": nodes, "ranked(i, doc_id, rank, deg, n, done)": ranked,
             "final": "SELECT * FROM ranked WHERE i = (SELECT max(i) FROM ranked)"}
    return _sql(select, graph, *needs, extra=extra, recursive=True)


def _summary(words: str, name: str) -> str:
    return (f"SELECT {name} AS token, field_id, count(*) AS n, sum(pos)::BIGINT AS sum_pos, "
            f"sum(doc_len)::BIGINT AS sum_len FROM {words} GROUP BY ALL")


_PLAIN = "SELECT term, field_id, doc_id, tf, array_to_string(positions, ',') AS positions, doc_len FROM {}"
_CONVERSATION_SPLIT = """
    SELECT conv_id * 1000 + turn AS query_id, text AS raw FROM conversations"""


def _conversation_sql(select: str) -> str:
    """Query analysis over the conversation turns instead of the fixed queries."""
    done: dict[str, str] = {}
    _collect(("slots",), done)
    done["q"] = _CONVERSATION_SPLIT
    steps = ",\n".join(f"{name} AS MATERIALIZED ({body})" for name, body in done.items())
    return f"WITH {steps}\n{select}"


def _request_sql() -> str:
    log = r"""
        SELECT conv_id * 1000 + turn AS query_id, CASE turn % 4 WHEN 0 THEN 'method=text&' WHEN 1 THEN 'method=TextRank&'
            WHEN 2 THEN 'method=boolean&' ELSE CASE WHEN conv_id % 2 = 0 THEN 'method=x&' ELSE '' END END || 'keyword=%20'
            || array_to_string(string_split(regexp_replace(text, '[^\p{L}\p{N} ]+', '', 'g'), ' '), '+')
            || CASE WHEN turn % 2 = 0 THEN '&page=' || turn ELSE '&page=x&a=b=c' END AS raw FROM conversations"""
    decode = _trim("url_decode(replace({}, '+', ' '))")
    names = _list(rq.METHODS)
    return f"""
        WITH log AS ({log}),
        pairs AS (SELECT query_id, unnest(string_split(raw, '&')) AS pair, generate_subscripts(string_split(raw, '&'), 1) AS i FROM log),
        parts AS (SELECT query_id, i, {_without_tail("string_split(pair, '=')")} AS p FROM pairs),
        kv AS (SELECT query_id, i, {decode.format('p[1]')} AS k, {decode.format('p[2]')} AS val FROM parts WHERE len(p) = 2),
        good AS (SELECT * FROM kv WHERE k <> '' AND val <> ''),
        vals AS (SELECT l.query_id, l.raw, lower(min_by(val, i) FILTER (k = 'method')) AS m, min_by(val, i) FILTER (k = 'keyword') AS kw,
            min_by(val, i) FILTER (k = 'page') AS pg, count(k) > count(DISTINCT k) AS twice
            FROM log l LEFT JOIN good USING (query_id) GROUP BY ALL),
        checked AS (SELECT *, CASE WHEN twice THEN '{rq.REPEATED}' WHEN m IS NULL THEN '{rq.NO_METHOD}' WHEN kw IS NULL
            THEN '{rq.NO_KEYWORD}' WHEN m NOT IN ({names}) THEN '{rq.bad_method(rq.METHODS)}' END AS error FROM vals)
        SELECT query_id, raw, CASE WHEN error IS NULL THEN m END AS method, CASE WHEN error IS NULL THEN kw END AS keyword,
            CASE WHEN error IS NULL THEN (CASE WHEN pg IS NULL THEN 0 ELSE coalesce(TRY_CAST(pg AS INTEGER), 1) END - 1)::INTEGER END AS page,
            error FROM checked"""


def _html_sql() -> str:
    """Extraction by patterns; enough for these pages, whose articles hold h1, p, b and br only.

    Whatever stands between two paragraph marks is a block of its own, after the title is cut out.
    """
    def plain(markup: str) -> str:
        bare = f"regexp_replace({markup}, '<[^>]*>', '', 'g')"
        return f"regexp_replace(replace({bare}, '&quot;', '\"'), '&amp;?', '&', 'g')"

    def spaced(text: str) -> str:
        return rf"trim(regexp_replace({text}, '\s+', ' ', 'g'))"

    return _sql(rf"""
        SELECT page_id, title, content, categories, '2018-02-01 00:00' AS last_modify, coalesce(out_links, '') AS out_links FROM (
            SELECT page_id, {spaced(plain("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)"))} AS title,
                array_to_string(list_filter(list_transform(
                    regexp_split_to_array(regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '(?s)<h1>.*?</h1>', ''), '</?p>'),
                    lambda p: {_trim(plain('p'))}), lambda p: p <> ''), chr(10)) AS content,
                array_to_string(list_transform(regexp_extract_all(regexp_extract(html, '(?s)<nav>.*?</nav>'), '(?s)<li>(.*?)</li>', 1),
                    lambda c: {spaced(plain('c'))}), '|') AS categories
            FROM pages) LEFT JOIN (
            SELECT page_id, string_agg(title, '|' ORDER BY i) AS out_links FROM (
                SELECT page_id, replace(regexp_extract(p, '{v.PATH_PATTERN}', 1), '_', ' ') AS title, min(i) AS i FROM (
                    SELECT page_id, i, url_decode(replace({_url('link', 3)}, '+', ' ')) AS p FROM page_links
                    WHERE is_url AND i > 0 AND regexp_matches({_url('link', 3)}, '{v.PATH_PATTERN}'))
                WHERE regexp_matches(p, '{v.PATH_PATTERN}') GROUP BY page_id, title) GROUP BY page_id) USING (page_id)
        WHERE content <> ''""", "page_links")


_SENTENCES = r"regexp_split_to_array(content, '[,;.\n]')"


def _sentence_snippet_sql() -> str:
    def count(word: str) -> str:
        return rf"len(regexp_extract_all(s, '(?i)[ ]+{word}[ ]+'))"

    the, la = count("the"), count("la")
    line = r"regexp_replace(regexp_replace({}, '\r\n|\r|\n', ' ', 'g'), '[ ]+', ' ', 'g')".format(_highlight("s", "the la", "b"))
    return _sql(f"""
        SELECT doc_id, '... ' || string_agg(line, ' ... ' ORDER BY rn) || ' ...' AS snippet FROM (
            SELECT doc_id, {line} AS line, row_number() OVER (PARTITION BY doc_id ORDER BY least({the}, {la}) * 20 + {the} + {la} DESC, i) AS rn
            FROM (SELECT doc_id, unnest(parts) AS s, generate_subscripts(parts, 1) AS i FROM (
                SELECT doc_id, {_without_tail(_SENTENCES)} AS parts FROM wiki_pages)))
        WHERE rn <= 5 GROUP BY doc_id
        UNION ALL SELECT doc_id, '...  ...' FROM wiki_pages WHERE len({_without_tail(_SENTENCES)}) = 0""", "wiki_pages")


def _fragment_snippet_sql() -> str:
    return _sql(r"""
        SELECT 1 AS query_id, doc_id, '... ' || string_agg(line, ' ... ' ORDER BY rn) || ' ...' AS snippet FROM (
            SELECT doc_id, regexp_replace(regexp_replace(string_agg(marked, '' ORDER BY i), '\r\n|\r|\n', ' ', 'g'), '[ ]+', ' ', 'g') AS line,
                row_number() OVER (PARTITION BY doc_id ORDER BY count(DISTINCT hit) DESC, fragment) AS rn
            FROM (SELECT *, CASE WHEN lower(word) IN ('the', 'la') THEN lower(word) END AS hit,
                CASE WHEN lower(word) IN ('the', 'la') THEN lead || '<B>' || word || '</B>' ELSE piece END AS marked,
                sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY i) // 100 AS fragment
                FROM (SELECT doc_id, piece, i, regexp_extract(piece, '[\p{L}\p{N}]+$') AS word,
                    regexp_extract(piece, '^[^\p{L}\p{N}]*') AS lead FROM (
                    SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) AS i FROM (
                        SELECT doc_id, regexp_extract_all(content, '[^\p{L}\p{N}]*[\p{L}\p{N}]+') AS p FROM wiki_pages))))
            GROUP BY doc_id, fragment HAVING count(DISTINCT hit) > 0) WHERE rn <= 5 GROUP BY doc_id""", "wiki_pages")


ORACLE: dict[str, str] = {
    "page_scan": _sql("""SELECT doc_id, title, length(content) AS content_chars, array_to_string(categories, '|') AS categories
        FROM wiki_pages""", "wiki_pages"),
    "page_count": _sql("SELECT count(*) AS n_pages, count(*) = 0 AS is_empty FROM raw_pages WHERE content <> ''", "raw_pages"),
    "table_lifecycle": _sql(f"""SELECT title, count(*) AS n, sum(length(content))::BIGINT AS chars,
            sum(len({_without_tail("string_split(joined, '|')")}))::BIGINT AS links, strftime(max(last_modify), {_PAGE_STAMP}) AS latest
        FROM (SELECT r.*, coalesce(j, '') AS joined FROM raw_pages r LEFT JOIN (
            SELECT arrival, string_agg(line, '|' ORDER BY i) AS j FROM (SELECT arrival, line, min(i) AS i FROM (
                SELECT arrival, trim(unnest(string_split(content, chr(10)))) AS line,
                    generate_subscripts(string_split(content, chr(10)), 1) AS i FROM raw_pages)
                WHERE line <> '' GROUP BY arrival, line) GROUP BY arrival) USING (arrival)) GROUP BY title""", "raw_pages"),
    "bad_line_quarantine": _sql("""SELECT 'good' AS status, arrival AS id, title, length(content) AS chars FROM raw_pages
            WHERE categories[2] NOT IN ('de', 'es')
        UNION ALL SELECT 'bad', arrival, NULL, NULL FROM raw_pages WHERE categories[2] = 'de'""", "raw_pages"),
    "json_export_rows": _sql("""SELECT w.doc_id AS id, title, title AS name, md5(content) AS content_md5,
            array_to_string(categories, '|') AS categories, coalesce(links, '') AS links FROM wiki_pages w LEFT JOIN (
            SELECT src AS doc_id, string_agg(dst::VARCHAR, ',' ORDER BY pos) AS links FROM doc_links GROUP BY src) USING (doc_id)""",
            "doc_links"),
    "posting_text_export": _sql("""SELECT term || chr(9) || string_agg(doc_id || ':' || array_to_string(tf, ',') || '|'
            || array_to_string(positions, ','), ';' ORDER BY doc_id) AS line FROM posting_entries GROUP BY term, doc_id // 65536""",
            "posting_entries"),
    "posting_text_roundtrip": _sql(
        "SELECT term, field_id, doc_id, tf, array_to_string(positions, ',') AS positions FROM postings", "postings"),
    "rank_text_import": _sql("""SELECT doc_id, round(1.0::DOUBLE / n, 12) AS rank, round(1.0::DOUBLE / n, 12) AS max_rank FROM (
            SELECT src AS doc_id, count(*) OVER () AS n FROM part_links GROUP BY src)""", "part_links"),
    "serving_lookup": _sql("SELECT term, field_id, df FROM term_stats WHERE term IN (SELECT term FROM slots)", "term_stats", "slots"),
    "first_wins_dedupe": _sql("""SELECT arrival, title, categories[1] AS source, false AS is_new FROM raw_pages WHERE categories[1] = 'src1'
            QUALIFY row_number() OVER (PARTITION BY title ORDER BY arrival) = 1
        UNION ALL (SELECT arrival, title, categories[1], true FROM raw_pages
            WHERE title NOT IN (SELECT title FROM raw_pages WHERE categories[1] = 'src1')
            QUALIFY row_number() OVER (PARTITION BY title ORDER BY arrival) = 1)""", "raw_pages"),
    "page_filter": _sql("SELECT arrival, title FROM raw_pages WHERE content <> ''", "raw_pages"),
    "html_extract": _html_sql(),
    "last_modified_parse": f"""SELECT event_id, strftime(CASE WHEN event_type = 'error' THEN TIMESTAMP '{v.INGEST_TS}'
        ELSE date_trunc('minute', ts) END, '%Y-%m-%d %H:%M:%S') AS last_modify FROM events""",
    "url_normalise": _sql(f"""SELECT DISTINCT page_id, lower({_url('link', 1)}) || '://' || {_url('link', 2)} || {_url('link', 3)}
            || {_url('link', 4)} AS url FROM page_links WHERE is_url AND starts_with({_url('link', 3)}, '/')""", "page_links"),
    "link_titles": _sql(f"""SELECT DISTINCT page_id, replace(regexp_extract(p, '{v.PATH_PATTERN}', 1), '_', ' ') AS title FROM (
            SELECT page_id, url_decode(replace({_url('link', 3)}, '+', ' ')) AS p FROM page_links
            WHERE is_url AND i > 0 AND regexp_matches({_url('link', 3)}, '{v.PATH_PATTERN}'))
        WHERE regexp_matches(p, '{v.PATH_PATTERN}')""", "page_links"),
    "frontier_bfs": _sql("SELECT node, min(depth)::INTEGER AS depth FROM bfs GROUP BY node", "part_links", recursive=True, extra={
        "bfs(node, depth)": """SELECT min(src), 0 FROM part_links UNION
            SELECT dst, depth + 1 FROM bfs JOIN part_links ON src = node WHERE depth < 10"""}),
    "visited_suppression": _sql("SELECT DISTINCT dst AS node FROM part_links WHERE dst NOT IN (SELECT src FROM part_links)", "part_links"),
    "page_budget": _sql("""SELECT dst AS node, count(*)::INTEGER AS depth FROM part_links GROUP BY dst
            ORDER BY depth, node LIMIT 1000""", "part_links"),
    "robots_rules": _sql("SELECT host, ordinal, path_prefix, allow FROM robots_rules", "robots_rules"),
    "robots_gate": _sql(f"""SELECT page_id, coalesce(min_by(allow, ordinal), true) AS allowed FROM pages LEFT JOIN robots_rules
            ON host = {_url('url', 2)} AND starts_with({_url('url', 3)} || {_url('url', 4)}, path_prefix) GROUP BY page_id""", "robots_rules"),
    "page_urls": _sql("""SELECT doc_id, 'https://en.wikipedia.org/wiki/' || replace(title, ' ', '_') AS url,
            array_to_string(list_transform(categories, lambda c: 'https://en.wikipedia.org/wiki/Category:' || replace(c, ' ', '_')), ' ')
            AS category_urls FROM wiki_pages""", "wiki_pages"),
    "tokens_positional": _sql(_summary("tokens", "token"), "tokens"),
    "tokens_clean": _sql(_summary("all_words", "term"), "all_words"),
    "stopword_filter": _sql(_summary("words", "term"), "words"),
    "split_query": f"""SELECT query_id, lower(CASE WHEN role = 'user' THEN {_trim('text')} ELSE text END) AS keyword,
            CASE WHEN role = 'user' THEN 'src1' ELSE '' END AS category
            FROM (SELECT conv_id * 1000 + turn AS query_id, role, text FROM conversations)""",
    "query_terms": _conversation_sql("SELECT query_id, clause, slot::INTEGER AS pos, term FROM slots"),
    "query_tf": _conversation_sql("SELECT query_id, clause, term, qf::INTEGER AS qf FROM slots WHERE is_first"),
    "dense_ids": _sql("SELECT arrival, title, row_number() OVER (ORDER BY title) - 1 AS doc_id FROM unique_pages", "unique_pages"),
    "even_split": """SELECT (w - 1)::INTEGER AS worker, count(*) AS n, min(i) AS first, max(i) AS last FROM (
            SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS i, ntile(7) OVER (ORDER BY o_orderkey) AS w FROM orders) GROUP BY w""",
    "link_resolution": _sql("SELECT src, dst FROM doc_links", "doc_links"),
    "adjacency": _sql("SELECT src AS id, string_agg(dst::VARCHAR, ',' ORDER BY pos) AS links FROM doc_links GROUP BY src", "doc_links"),
    "pipe_arrays": _sql(f"""SELECT arrival, len(parts)::INTEGER AS n, md5(coalesce(array_to_string(parts, '|'), '')) AS back_md5 FROM (
            SELECT arrival, {_without_tail("string_split(replace(content, chr(10), '|'), '|')")} AS parts FROM raw_pages)""", "raw_pages"),
    "doc_lengths": _sql("SELECT doc_id, field_id, len FROM doc_lengths", "doc_lengths"),
    "field_stats": _sql("SELECT field_id, total_len, n_docs, round(avg_len, 6) AS avg_len FROM field_stats", "field_stats"),
    "postings_plain": _sql(_PLAIN.format("postings"), "postings"),
    "postings_standard": _sql(_PLAIN.format("std_postings"), "std_postings"),
    "posting_lists": _sql("""SELECT term, doc_id // 100 AS block, count(*) AS df, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS docs
            FROM posting_entries GROUP BY ALL""", "posting_entries"),
    "term_stats": _sql("SELECT term, field_id, df FROM term_stats", "term_stats"),
    "pagerank_init": _rank_sql("SELECT doc_id, round(rank, 12) AS rank FROM final WHERE deg IS NOT NULL", "part_links", 0),
    "pagerank_step": _rank_sql("SELECT doc_id, round(rank, 12) AS rank FROM final", "part_links", 1),
    "pagerank_fixed": _rank_sql("SELECT doc_id, round(rank, 12) AS rank FROM final", "part_links", 3),
    "pagerank_converged": _rank_sql("SELECT doc_id, round(rank, 12) AS rank, i AS rounds FROM final", "supplier_links", None),
    "pagerank_dangling": _rank_sql("SELECT doc_id, round(rank, 12) AS rank FROM final WHERE deg IS NULL", "part_links", None),
    "rank_max": _rank_sql("SELECT round(max(rank), 12) AS max_rank FROM final", "supplier_links", None),
    "posting_fetch": _sql("SELECT query_id, clause, slot::INTEGER AS slot, term, field_id, doc_id, tf, df FROM hits", "hits"),
    "bm25_terms": _sql("""SELECT query_id, clause, term, field_id, doc_id, round(score, 6) AS score FROM scored WHERE is_first""", "scored"),
    "match_coverage": _sql("""SELECT query_id, clause, field_id, doc_id, n_matched, n_distinct::INTEGER AS n_distinct,
            round(raw, 6) AS raw, n_matched = n_distinct AS all_terms FROM coverage""", "coverage"),
    "adjacency_match": _sql("""SELECT query_id, clause, field_id, doc_id, n_adjacent, n_terms::INTEGER AS n_terms FROM matched
            WHERE n_adjacent IS NOT NULL""", "matched"),
    "field_score": _sql("SELECT query_id, clause, field_id, doc_id, match, round(score, 6) AS score FROM field_scored", "field_scored"),
    "combine_inner": _sql("""SELECT query_id, doc_id, round(title, 6) AS title, round(content, 6) AS content, round(text, 6) AS text
            FROM combined""", "combined"),
    "combine_outer": _sql("""SELECT query_id, doc_id, round(text, 6) AS text FROM wide
            WHERE title IS NOT NULL OR content IS NOT NULL""", "wide"),
    "category_search": _sql("""SELECT query_id, doc_id, round(cat, 6) AS category_score, round(text, 6) AS text FROM combined
            WHERE cat IS NOT NULL""", "combined"),
    "hits": _sql("SELECT query_id, hits FROM hit_counts", "hit_counts"),
    "minmax_norm": _sql("SELECT query_id, doc_id, round(text, 6) AS text FROM normalised", "normalised"),
    "rank_blend": _rank_sql("""SELECT query_id, doc_id, round(text * 0.9 + r * 0.1, 5) AS total, round(text, 5) AS text, round(r, 5) AS rank
            FROM (SELECT query_id, doc_id, text, coalesce(f.rank, 1.0 / (SELECT count(*) FROM wiki_pages))
                / (SELECT max(rank) FROM final) * 1000 AS r FROM normalised LEFT JOIN final f USING (doc_id))""",
            "doc_links", None, "normalised", epsilon=1e-6),
    "topk": _sql("SELECT query_id, rn::INTEGER AS rn, doc_id, round(total, 6) AS total FROM best", "best"),
    "score_text": _sql("SELECT query_id, doc_id, printf('%.8f', round(text, 5)) AS score FROM combined", "combined"),
    "phrase_match": _sql("SELECT query_id, clause, field_id, doc_id, phrase_tf FROM phrases", "phrases"),
    "clause_scores": _sql("""SELECT query_id, clause, field_id, doc_id, round(phrase_clause, 6) AS phrase_clause,
            round(all_clause, 6) AS all_clause, round(any_clause, 6) AS any_clause, round(score, 6) AS score
            FROM std_clause_scores""", "std_clause_scores"),
    "boolean_rank": _sql("""SELECT query_id, doc_id, count(*) OVER (PARTITION BY query_id) AS hits, round(text, 6) AS total
            FROM std_combined QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY text DESC, doc_id) <= 1000""", "std_combined"),
    "fragment_snippet": _fragment_snippet_sql(),
    "highlight": _sql(f"SELECT doc_id, {_highlight('title', 'the an s', 'span')} AS title FROM wiki_pages", "wiki_pages"),
    "sentence_snippet": _sentence_snippet_sql(),
    "paginate": _sql("""SELECT query_id, rn::INTEGER AS rn, doc_id, (page + 1)::INTEGER AS page_no, total_pages FROM paged""", "paged"),
    "result_page": _sql("""SELECT query_id, rn::INTEGER AS rn, doc_id, title, raw_title, snippet, array_to_string(categories, '|') AS categories,
            array_to_string(raw_categories, '|') AS raw_categories, last_modify, score FROM shown_rows""", "shown_rows"),
    "response_json": _sql(f"""SELECT query_id, CASE WHEN hits = 0 THEN '{{"hits":0}}' ELSE to_json({{'hits': hits, 'pages': pages,
            'pageNo': page_no, 'totalPages': total_pages}})::VARCHAR END AS response FROM hit_counts LEFT JOIN (
            SELECT query_id, page_no, total_pages, list({{'title': title, 'url': {_PAGE} || replace(raw_title, ' ', '_'), 'snippet': snippet,
                'categories': {{'html': categories, 'href': list_transform(raw_categories, lambda c: {_CATEGORY} || replace(c, ' ', '_'))}},
                'lastModify': last_modify, 'score': score}} ORDER BY rn) AS pages FROM shown_rows GROUP BY ALL) USING (query_id)""",
            "shown_rows", "hit_counts"),
    "request_log": _request_sql(),
    "batch_search": _sql("""SELECT h.query_id, h.hits, 'https://en.wikipedia.org/wiki/' || replace(w.title, ' ', '_') AS first_url,
            total_pages FROM hit_counts h LEFT JOIN (SELECT query_id, min_by(doc_id, rn) AS doc_id,
                ceil(count(*) / 10)::INTEGER AS total_pages FROM best GROUP BY query_id) b USING (query_id)
            LEFT JOIN wiki_pages w ON w.doc_id = b.doc_id""", "hit_counts", "best", "wiki_pages"),
    "json_pointer_columns": """SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.k') AS k_fragment,
            NULL::VARCHAR AS inside, NULL::VARCHAR AS missing, json_extract_string(props, '$.k') AS nested FROM events""",
    "stream_progress": _sql("""SELECT wave::BIGINT AS ingest_batch, n_arrived, coalesce(n_inserted, 0) AS n_inserted,
            sum(coalesce(n_inserted, 0)) OVER (ORDER BY wave)::BIGINT AS n_total
        FROM (SELECT wave, count(*) AS n_arrived FROM waves GROUP BY wave) LEFT JOIN (
            SELECT wave, count(*) AS n_inserted FROM (SELECT title, min(wave) AS wave FROM waves WHERE content <> '' GROUP BY title)
            GROUP BY wave) USING (wave)""", "raw_pages", extra={"waves": """
        SELECT title, content, CASE categories[2] WHEN 'en' THEN 0 WHEN 'de' THEN 1 ELSE 2 END AS wave FROM raw_pages"""}),
    "versioned_publish": _sql("SELECT term, field_id, df FROM term_stats", "term_stats"),
    "vocabulary_growth": _sql("""SELECT term AS token, count(*) AS n_occ, count(*) FILTER (w.categories[1] = 'src1') = 0 AS is_new
        FROM words JOIN wiki_pages w USING (doc_id) GROUP BY term""", "words"),
    "stream_ingest": _sql("""SELECT title, min(arrival) AS arrival FROM raw_pages WHERE content <> '' GROUP BY title""", "raw_pages"),
}
