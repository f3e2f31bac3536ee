"""DuckDB SQL for the correctness oracle.

Each query in the catalog has an SQL twin here, written independently
against the raw driver tables (views ``documents``, ``benchmark``,
``pages``, ``embeddings``, ...). Shared CTEs are composed as text.
"""

from __future__ import annotations

from quarry.config import DEFAULT

P = DEFAULT
# Told apart from the library's classes: ASCII punctuation by its name, white space as the separators and the controls that part words.
PUNCT = "[[:punct:]]"
SPACE = r"\pZ\x09-\x0D\x1C-\x1F\x{85}"
BREAK = r"\x0A-\x0D\x1C-\x1E\x{85}\x{2028}\x{2029}"


def norm(x: str) -> str:
    """P2 in DuckDB."""
    return (
        f"lower(regexp_replace(regexp_replace(regexp_replace({x}, '{PUNCT}', ' ', 'g'), "
        f"'[{SPACE}]+', ' ', 'g'), '^ | $', '', 'g'))"
    )


def ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


DOCS = "docs AS (SELECT CAST(doc_id AS VARCHAR) AS url, doc_id AS doc_seq, text FROM documents)"
TOKS = f"toks AS (SELECT url, CAST(length(text) AS BIGINT) AS dl, unnest(string_split({norm('text')}, ' ')) AS term FROM docs)"
POSTINGS = "postings AS (SELECT term, url, dl, count(*) AS tf FROM toks GROUP BY term, url, dl)"
STATS = "stats AS (SELECT count(*) AS n_docs, avg(length(text)) AS avdl, CAST(coalesce(sum(length(text)), 0) AS BIGINT) AS total_len FROM docs)"
TSTATS = "tstats AS (SELECT term, count(*) AS df FROM postings GROUP BY term)"
QUERIES = (
    f"queries AS (SELECT item_id AS query_id, {norm('text')} AS query "
    "FROM benchmark)"
)
QTERMS = (
    "qterms AS (SELECT query_id, unnest(range(len(t))) AS pos, unnest(t) AS term "
    "FROM (SELECT query_id, string_split(query, ' ') AS t FROM queries))"
)
QRELS = (
    "qrels AS (SELECT b.item_id AS query_id, CAST(d.doc_id AS VARCHAR) AS url "
    "FROM documents d JOIN benchmark b ON instr(d.text, b.text) > 0)"
)


def idf(df: str, n: str) -> str:
    return f"ln(({n} - {df} + 0.5) / ({df} + 1.0) + 1.0)"


def bm25(tf: str, dl: str, avdl: str, idf_expr: str) -> str:
    return (
        f"({idf_expr}) * {tf} * {P.k1 + 1.0} / ({tf} + {P.k1} * ({1.0 - P.b} + {P.b} * {dl} / {avdl}))"
    )


TERM_BM25 = (
    "term_bm25 AS (SELECT p.term, p.url, "
    + bm25("p.tf", "p.dl", "s.avdl", idf("t.df", "s.n_docs"))
    + " AS bm25 FROM postings p JOIN tstats t ON p.term = t.term CROSS JOIN stats s "
    "WHERE p.term IN (SELECT term FROM qterms))"
)
QWEIGHTS = f"qweights AS (SELECT query_id, term, count(*) * {P.w_original} AS weight FROM qterms GROUP BY query_id, term)"
LEX = (
    "lex AS (SELECT w.query_id, b.url, sum(w.weight * b.bm25) AS score "
    "FROM qweights w JOIN term_bm25 b ON w.term = b.term GROUP BY w.query_id, b.url)"
)
LEX_BASE = [DOCS, TOKS, POSTINGS, STATS, TSTATS, QUERIES, QTERMS, TERM_BM25, QWEIGHTS, LEX]

RANKED_LEX = (
    "ranked AS (SELECT query_id, url, score, row_number() OVER (PARTITION BY query_id "
    "ORDER BY round(score, 9) DESC, url ASC) AS rank FROM lex)"
)


METRICS = ("precision_at_k", "recall_at_k", "rr", "ndcg")


def metrics_sql(ranked_cte_parts: list[str], k: int, per_query: tuple[str, ...] = ()) -> str:
    """The named metrics of each query, or the means of all."""
    judged = (
        "judged AS (SELECT q.query_id, q.url, r.rank FROM qrels q JOIN ranked r "
        "ON q.query_id = r.query_id AND q.url = r.url)"
    )
    nrel = "nrel AS (SELECT query_id, count(*) AS n_rel FROM (SELECT DISTINCT query_id, url FROM qrels) GROUP BY query_id)"
    agg = (
        f"agg AS (SELECT query_id, sum(CASE WHEN rank <= {k} THEN 1 ELSE 0 END) AS hits, max(1.0 / rank) AS rr, "
        f"sum(CASE WHEN rank <= {k} THEN 1.0 / log2(rank + 1) ELSE 0.0 END) AS dcg FROM judged GROUP BY query_id)"
    )
    ideal = (
        f"ideal AS (SELECT n.query_id, sum(1.0 / log2(i + 1)) AS idcg FROM nrel n, "
        f"range(1, {k} + 1) t(i) WHERE i <= n.n_rel GROUP BY n.query_id)"
    )
    pq = (
        "pq AS (SELECT q.query_id, "
        f"coalesce(a.hits, 0) / {float(k)} AS precision_at_k, "
        "CASE WHEN coalesce(n.n_rel, 0) > 0 THEN coalesce(a.hits, 0) / n.n_rel ELSE 0.0 END AS recall_at_k, "
        "coalesce(a.rr, 0.0) AS rr, "
        "CASE WHEN coalesce(i.idcg, 0) > 0 THEN coalesce(a.dcg, 0.0) / i.idcg ELSE 0.0 END AS ndcg "
        "FROM (SELECT DISTINCT query_id FROM queries) q LEFT JOIN nrel n ON q.query_id = n.query_id "
        "LEFT JOIN agg a ON q.query_id = a.query_id LEFT JOIN ideal i ON q.query_id = i.query_id)"
    )
    head = ctes(*ranked_cte_parts, QRELS, judged, nrel, agg, ideal, pq)
    if per_query:
        return head + "SELECT query_id, " + ", ".join(f"round({m}, 6) AS {m}" for m in per_query) + " FROM pq"
    return head + (
        "SELECT round(coalesce(avg(precision_at_k), 0.0), 6) AS precision_at_k, "
        "round(coalesce(avg(recall_at_k), 0.0), 6) AS recall_at_k, round(coalesce(avg(rr), 0.0), 6) AS mrr, "
        "round(coalesce(avg(ndcg), 0.0), 6) AS ndcg, count(*) AS n_queries FROM pq"
    )


# ---------------------------------------------------------------- vectors

def hdim(f: str, size: int) -> str:
    return f"CAST(CAST(('0x' || substr(md5({f}), 1, 7)) AS BIGINT) % {size} AS INTEGER)"


def hsign(f: str) -> str:
    return f"CASE WHEN substr(md5({f}), 8, 1) < '8' THEN CAST(1 AS DOUBLE) ELSE CAST(-1 AS DOUBLE) END"


def _unit(name: str, keys: str, size: int, feats: str) -> list[str]:
    return [
        f"{name}_f AS ({feats})",
        f"{name}_d AS (SELECT {keys}, {hdim('f', size)} AS dim, sum({hsign('f')}) AS v FROM {name}_f GROUP BY ALL)",
        f"{name} AS (SELECT {keys}, dim, CASE WHEN nrm > 0 THEN v / nrm ELSE 0.0 END AS w FROM "
        f"(SELECT *, sqrt(sum(v * v) OVER (PARTITION BY {keys})) AS nrm FROM {name}_d))",
    ]


def word_vec(name: str, src: str, key: str, text: str, size: int = P.text_dim) -> list[str]:
    """Hashed word vectors (key, dim, w) of ``src``; empty words ignored."""
    feats = (f"SELECT {key}, unnest(list_filter(string_split({norm(text)}, ' '), lambda x: x <> '')) AS f FROM {src}")
    return _unit(name, key, size, feats)


def trigram_vec(name: str, src: str, keys: str, term: str, size: int = P.term_dim) -> list[str]:
    feats = (f"SELECT {keys}, unnest(list_transform(range(1, length('#' || {term} || '#') - 1), "
             f"lambda i: substr('#' || {term} || '#', i, 3))) AS f FROM {src}")
    return _unit(name, keys, size, feats)


def postings_of(name: str, docs: str) -> list[str]:
    return [
        f"{name}_t AS (SELECT url, CAST(length(text) AS BIGINT) AS dl, unnest(string_split({norm('text')}, ' ')) AS term FROM {docs})",
        f"{name} AS (SELECT term, url, dl, count(*) AS tf FROM {name}_t GROUP BY term, url, dl)",
    ]


def stats_of(name: str, docs: str) -> str:
    return (f"{name} AS (SELECT count(*) AS n_docs, avg(length(text)) AS avdl, "
            f"CAST(coalesce(sum(length(text)), 0) AS BIGINT) AS total_len FROM {docs})")


def tstats_of(name: str, postings: str) -> str:
    return f"{name} AS (SELECT term, count(*) AS df FROM {postings} GROUP BY term)"


def vocab_of(name: str, tstats: str, stats: str) -> str:
    return (f"{name} AS (SELECT t.term, t.df FROM {tstats} t, {stats} s "
            f"WHERE t.df > s.n_docs * {P.vocab_min_df_frac})")


def expansion(docs: str = "docs") -> list[str]:
    """V6: best seed per document and the expanded text (exp_docs)."""
    return word_vec("rv", docs, "url", "text") + [
        f"seed AS (SELECT url, doc_seq, text FROM {docs} ORDER BY doc_seq LIMIT {P.seed_size})",
        f"cand AS (SELECT d.url, d.doc_seq, s.url AS s_url, s.doc_seq AS s_seq FROM {docs} d JOIN seed s ON s.doc_seq < d.doc_seq)",
        "sdot AS (SELECT a.url, b.url AS s_url, sum(a.w * b.w) AS dot FROM rv a JOIN rv b ON a.dim = b.dim "
        "WHERE b.url IN (SELECT url FROM seed) GROUP BY a.url, b.url)",
        "csim AS (SELECT c.url, c.s_url, c.s_seq, round(coalesce(sd.dot, 0.0), 9) AS sim, "
        "count(*) OVER (PARTITION BY c.url) AS n_pred, "
        "row_number() OVER (PARTITION BY c.url ORDER BY round(coalesce(sd.dot, 0.0), 9) DESC, c.s_seq ASC) AS rn "
        "FROM cand c LEFT JOIN sdot sd ON c.url = sd.url AND c.s_url = sd.s_url)",
        f"best AS (SELECT d.url, coalesce(c.n_pred, 0) AS n_pred, CASE WHEN c.n_pred >= 2 THEN c.s_url END AS seed_url, "
        f"CASE WHEN c.n_pred >= 2 THEN c.sim END AS sim FROM {docs} d LEFT JOIN (SELECT * FROM csim WHERE rn = 1) c ON d.url = c.url)",
        f"exp_docs AS (SELECT d.url, d.doc_seq, CASE WHEN b.sim > {P.expand_threshold} THEN d.text || ' ' || s.text ELSE d.text END AS text "
        f"FROM {docs} d JOIN best b ON d.url = b.url LEFT JOIN seed s ON b.seed_url = s.url)",
    ]


def query_side(docs: str, expand_q: bool = True) -> list[str]:
    """Index over ``docs`` (postings, stats, vocabulary vectors) and the
    expanded, weighted query terms (qw)."""
    parts = postings_of("ipost", docs) + [stats_of("istats", docs), tstats_of("its", "ipost")]
    parts += [QUERIES, QTERMS]
    if expand_q:
        parts += [vocab_of("ivocab", "its", "istats")]
        parts += trigram_vec("vv", "ivocab", "term", "term")
        parts += trigram_vec("wv", "qterms", "query_id, pos", "term")
        parts += [
            "wdot AS (SELECT a.query_id, a.pos, b.term, sum(a.w * b.w) AS dot FROM wv a JOIN vv b ON a.dim = b.dim "
            "GROUP BY a.query_id, a.pos, b.term)",
            "wsim AS (SELECT q.query_id, q.pos, v.term, round(coalesce(d.dot, 0.0), 9) AS sim FROM qterms q CROSS JOIN ivocab v "
            "LEFT JOIN wdot d ON q.query_id = d.query_id AND q.pos = d.pos AND v.term = d.term)",
            f"nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id, pos ORDER BY sim DESC, term ASC) AS rank "
            f"FROM wsim) WHERE rank <= {P.neighbours})",
            "firsts AS (SELECT query_id, term, min(pos * 1000000 + rank) AS k FROM nn GROUP BY query_id, term)",
            "newt AS (SELECT f.query_id, f.term, f.k FROM firsts f WHERE NOT EXISTS "
            "(SELECT 1 FROM qterms o WHERE o.query_id = f.query_id AND o.term = f.term))",
            "norig AS (SELECT query_id, count(*) AS n FROM qterms GROUP BY query_id)",
            "qexp AS (SELECT query_id, pos, term, true AS original FROM qterms UNION ALL "
            "SELECT t.query_id, n.n + row_number() OVER (PARTITION BY t.query_id ORDER BY t.k) - 1 AS pos, t.term, false AS original "
            "FROM newt t JOIN norig n ON t.query_id = n.query_id)",
        ]
    else:
        parts += ["qexp AS (SELECT query_id, pos, term, true AS original FROM qterms)"]
    parts += [
        f"qw AS (SELECT query_id, term, sum(CASE WHEN original THEN {P.w_original} ELSE {P.w_expanded} END) AS weight "
        "FROM qexp GROUP BY query_id, term)",
        "tb AS (SELECT p.term, p.url, " + bm25("p.tf", "p.dl", "s.avdl", idf("t.df", "s.n_docs"))
        + " AS bm25 FROM ipost p JOIN its t ON p.term = t.term CROSS JOIN istats s WHERE p.term IN (SELECT term FROM qw))",
        "hlex AS (SELECT w.query_id, b.url, sum(w.weight * b.bm25) AS lex FROM qw w JOIN tb b ON w.term = b.term "
        "GROUP BY w.query_id, b.url)",
    ]
    return parts


def cosine_side(docs: str) -> list[str]:
    return word_vec("dv", docs, "url", "text") + word_vec("qv", "queries", "query_id", "query") + [
        "qd AS (SELECT q.query_id, d.url, sum(q.w * d.w) AS dot FROM qv q JOIN dv d ON q.dim = d.dim GROUP BY q.query_id, d.url)",
        f"hcos AS (SELECT q.query_id, d.url, coalesce(qd.dot, 0.0) AS cos FROM queries q CROSS JOIN {docs} d "
        "LEFT JOIN qd ON q.query_id = qd.query_id AND d.url = qd.url)",
    ]


def hybrid(expand_docs: bool = True, expand_q: bool = True, docs: str = DOCS) -> list[str]:
    """Q3: hscore(query_id, url, lex, cos, score) for all pairs."""
    parts = [docs]
    src = "docs"
    if expand_docs:
        parts += expansion("docs")
        src = "exp_docs"
    parts += query_side(src, expand_q) + cosine_side(src)
    parts += [
        f"hscore AS (SELECT c.query_id, c.url, l.lex, c.cos, {P.w_lexical} * coalesce(l.lex, 0.0) + {P.w_semantic} * c.cos AS score "
        "FROM hcos c LEFT JOIN hlex l ON c.query_id = l.query_id AND c.url = l.url)",
    ]
    return parts


# ---------------------------------------------------------------- pages

def html_sql(x: str) -> str:
    """P1 in DuckDB (RE2: no back-references, so each element is its own
    pattern)."""
    from html.entities import name2codepoint

    c = f"coalesce({x}, '')"
    for tag in ("script", "style"):
        c = f"regexp_replace({c}, '(?is)<{tag}\\b[^>]*>.*?</{tag}\\s*>', '', 'g')"
    c = f"regexp_replace({c}, '(?s)<!--.*?-->', '', 'g')"
    for tag in (r"""<[!/?a-zA-Z][^>"']*(?:(?:"[^"]*"|'[^']*')[^>"']*)*>""", "<[!/?a-zA-Z][^>]*>"):
        quoted = tag.replace("'", "''")
        c = f"regexp_replace({c}, '{quoted}', '', 'g')"
    names = ", ".join(f"'{n}': chr({code})" for n, code in name2codepoint.items())
    bare = "lt|gt|quot|nbsp|copy|middot|amp"
    low = "".join(map(chr, range(128, 160)))
    high = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(128, 160))

    def char(code):
        return (f"translate(chr(CASE WHEN {code} BETWEEN 1 AND 1114111 AND {code} NOT BETWEEN 55296 AND 57343 "
                f"THEN {code} ELSE 65533 END), '{low}', '{high}')")

    dec = char("CAST(regexp_extract(p, '^#([0-9]{1,7})', 1) AS INT)")
    hexa = char("CAST('0x' || regexp_extract(p, '^#[xX]([0-9a-fA-F]{1,6})', 1) AS INT)")
    name = f"MAP {{{names}}}[regexp_extract(p, '^([A-Za-z][A-Za-z0-9]*);', 1)]"
    rest = "regexp_replace(p, '^#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});?', '')"
    c = f"""array_to_string(list_transform(string_split({c}, '&'), lambda p, i: CASE
        WHEN i = 1 THEN p
        WHEN regexp_matches(p, '^#[0-9]') THEN {dec} || {rest}
        WHEN regexp_matches(p, '^#[xX][0-9a-fA-F]') THEN {hexa} || {rest}
        WHEN {name} IS NOT NULL THEN {name} || regexp_replace(p, '^[A-Za-z0-9]+;', '')
        WHEN regexp_matches(p, '^(?:{bare})') THEN MAP {{{names}}}[regexp_extract(p, '^({bare})', 1)] || regexp_replace(p, '^(?:{bare});?', '')
        ELSE '&' || p END), '')"""
    sep = f"[{SPACE}]*(?:[{BREAK}]| {{2}})[{SPACE}]*"
    c = f"regexp_replace({c}, '{sep}', ' ', 'g')"
    return f"regexp_replace({c}, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')"
