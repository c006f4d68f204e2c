"""SQL equivalents of the queries that SQL can express, for DuckDB on the same tables."""

from __future__ import annotations

from geolink.llm.decontam import WINDOW as ITEM_WINDOW
from geolink.llm.mixing import DIGITS, EPOCHS, SEED, SHARE, WEIGHTS
from geolink.llm.search import TOP
from geolink.llm.substrings import WINDOW
from geolink.llm.urls import url_filter_sql

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _words(text: str, separators: str) -> str:
    return f"list_filter(string_split_regex(coalesce({text}, ''), '{separators}'), lambda x: x <> '')"


def substring_dedup_sql() -> str:
    words = _words("text", "[ \\t-\\r]+")
    return f"""
        WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
        windows AS (
            SELECT r, i, md5(array_to_string(w[i:i + {WINDOW - 1}], ' ')) AS h
            FROM (SELECT r, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM docs)),
        repeated AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
        cut AS (
            SELECT DISTINCT r, unnest(range(i, i + {WINDOW})) AS k
            FROM windows JOIN repeated USING (h)),
        placed AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM docs),
        kept AS (
            SELECT r, string_agg(word, ' ' ORDER BY k) AS body, count(*) AS n
            FROM placed ANTI JOIN cut USING (r, k) GROUP BY r)
        SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
               sha256(coalesce(body, '')) AS kept_sha256
        FROM docs LEFT JOIN kept USING (r)
    """


def _plain_words() -> str:
    # All ASCII characters but letters and digits separate words.
    low = f"translate(text, '{_UPPER}', '{_UPPER.lower()}')"
    return _words(low, "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def decontamination_sql() -> str:
    words = _plain_words()
    n = ITEM_WINDOW
    return f"""
        WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
        items AS (SELECT item_id, {words} AS w FROM benchmark),
        wanted AS (
            SELECT DISTINCT item_id, least(len(w), {n}) AS size,
                   array_to_string(w[i:i + least(len(w), {n}) - 1], ' ') AS gram
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {n - 2}, 2))) AS i
                  FROM items WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT size FROM wanted),
        grams AS (
            SELECT r, i, size, array_to_string(w[i:i + size - 1], ' ') AS gram
            FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, sizes)),
        hits AS (SELECT r, i, size, item_id FROM grams JOIN wanted USING (size, gram)),
        hit AS (
            SELECT r, count(DISTINCT k) AS n_hit
            FROM (SELECT DISTINCT r, unnest(range(i, i + size)) AS k FROM hits) GROUP BY r),
        named AS (
            SELECT r, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
            FROM (SELECT DISTINCT r, item_id::VARCHAR AS name FROM hits) GROUP BY r)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
    """


def ranked_search_sql() -> str:
    words = _plain_words()
    return f"""
        WITH docs AS (
            SELECT row_number() OVER () AS r, doc_id, {words} AS w, len(w)::BIGINT AS n FROM documents),
        total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS length FROM docs WHERE n > 0),
        asked AS (SELECT row_number() OVER () AS q, item_id, list_distinct({words}) AS t FROM benchmark),
        wanted AS (SELECT q, unnest(t) AS term FROM asked),
        placed AS (SELECT r, unnest(w) AS term FROM docs),
        held AS (
            SELECT r, term, count(*)::BIGINT AS tf
            FROM placed SEMI JOIN wanted USING (term) GROUP BY r, term),
        weights AS (
            SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight
            FROM held, total GROUP BY term, docs),
        scores AS (
            SELECT q, r, sum(weight * ((1000000000 * tf)
                // (1000 * tf + 8 * (100 - 90 + (90 * n * total.docs) // total.length))))::BIGINT AS score
            FROM held JOIN weights USING (term) JOIN wanted USING (term) JOIN docs USING (r), total
            GROUP BY q, r),
        ranked AS (
            SELECT item_id, doc_id, score,
                   row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank
            FROM scores JOIN docs USING (r) JOIN asked USING (q) WHERE score > 0)
        SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= {TOP}
    """


def source_mixing_sql() -> str:
    words = _words("text", "[ \\t-\\r]+")
    weights = ", ".join(map(str, WEIGHTS))
    return f"""
        WITH docs AS (
            SELECT doc_id, source, len({words})::BIGINT AS size,
                   substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'text:' || text, '')), 1, {DIGITS}) AS draw
            FROM documents),
        sources AS (
            SELECT source, source_size, {EPOCHS} * source_size AS cap, ([{weights}])[(place % {len(WEIGHTS)}) + 1] AS weight
            FROM (SELECT source, sum(size)::BIGINT AS source_size,
                         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
                  FROM docs GROUP BY source)),
        parts AS (
            SELECT *, cap::DOUBLE / weight AS fill,
                   ({SHARE}::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER lower, 0)::DOUBLE)
                   / (sum(weight) OVER () - coalesce(sum(weight) OVER lower, 0))::DOUBLE AS level
            FROM sources
            WINDOW lower AS (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        water AS (
            SELECT coalesce(first(level ORDER BY fill, source NULLS LAST) FILTER (WHERE fill > level), 0) AS level
            FROM parts),
        targets AS (
            SELECT source, source_size, least(cap::DOUBLE, weight * water.level) AS target,
                   floor(target + 0.5)::BIGINT AS wanted,
                   CASE WHEN source_size > 0 THEN wanted // source_size ELSE 0 END AS whole
            FROM sources, water),
        placed AS (
            SELECT *, sum(size) OVER (PARTITION BY source ORDER BY draw) AS upto,
                   sum(size) OVER (PARTITION BY source, draw) AS held
            FROM docs)
        SELECT doc_id, p.source AS source, size, source_size, target, whole::INTEGER AS whole,
               (size * whole + CASE
                    WHEN upto <= wanted - whole * source_size THEN size
                    WHEN upto - held >= wanted - whole * source_size THEN 0
                    ELSE size * (wanted - whole * source_size - upto + held)::BIGINT // held::BIGINT END)::BIGINT AS taken
        FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source
    """


def oracle_sql() -> dict[str, str]:
    return {
        "op2_substring_dedup": substring_dedup_sql(),
        "op3_url_filter": url_filter_sql(),
        "op5_decontamination": decontamination_sql(),
        "op11_ranked_search": ranked_search_sql(),
        "op13_source_mixing": source_mixing_sql(),
    }
