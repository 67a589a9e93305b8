"""SQL that gives the rows of queries which are long to state."""

from __future__ import annotations

LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def crc32_table() -> str:
    """A CTE body: one list of the 256 entries of the CRC-32 table."""
    step = "SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END AS v FROM ({})"
    rows = "SELECT range AS i, CAST(range AS BIGINT) AS v FROM range(256)"
    for _ in range(8):
        rows = step.format(rows)
    return f"SELECT list(v ORDER BY i) AS entries FROM ({rows})"


def crc32(text: str, entries: str) -> str:
    """SQL for the unsigned CRC-32 of an ASCII text."""
    bytes_ = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    return (
        f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bytes_}), "
        f"lambda c, b: xor(c >> 8, {entries}[(xor(c, b) & 255) + 1])), 4294967295)"
    )


def merkle_proofs(levels: int = 5) -> str:
    """Whole trees and folds by window functions, a CTE a level; a level of one node passes it on."""
    framed = lambda c: f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
    head = " || ".join(framed(c) for c in ("doc_id", "source", "lang", "n_chars"))
    parts = [
        f"table_of_crc AS ({crc32_table()})",
        f"hashed AS (SELECT doc_id, source, {framed('source')} AS k, sha256({head} || {framed('text')}) AS leaf, "
        f"CASE WHEN coalesce({crc32('CAST(doc_id AS VARCHAR)', 'entries')} % 5 = 0, false) THEN sha256({head} || {framed(LOWERED.format('text'))}) "
        f"ELSE sha256({head} || {framed('text')}) END AS claimed FROM documents, table_of_crc)",
        "leaves AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM hashed)",
        "a0 AS (SELECT k, i, leaf AS h FROM leaves)",
    ]
    run = "string_agg(h, '') OVER (PARTITION BY {by}i // 16 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    for n, (name, by) in enumerate([("a", "k, ")] * levels + [("b", "")] * levels):
        level = n % levels
        if name == "b" and level == 0:
            parts.append(
                f"b0 AS (SELECT row_number() OVER (ORDER BY s.source NULLS FIRST) - 1 AS i, s.k, a{levels}.h FROM "
                f"(SELECT DISTINCT source, k FROM hashed) s JOIN a{levels} ON a{levels}.k = s.k)"
            )
        of = f"PARTITION BY {by[:-2]}" if by else ""
        parts.append(
            f"{name}run{level} AS (SELECT {by}i, h, count(*) OVER ({of}) AS n, "
            f"{run.format(by=by)} AS run FROM {name}{level})"
        )
        parts.append(
            f"{name}{level + 1} AS (SELECT {by}i // 16 AS i, CASE WHEN min(n) = 1 THEN min(h) ELSE sha256(min(run)) END AS h "
            f"FROM {name}run{level} GROUP BY {by}i // 16)"
        )
    around = "substr({r}.run, 1, 64 * CAST({r}.i % 16 AS BIGINT)) || substr({r}.run, 64 * CAST({r}.i % 16 AS BIGINT) + 65)"
    folds, proof = [], []
    joins = [f"JOIN a{levels} AS sub ON sub.k = x.k", "JOIN b0 AS place ON place.k = x.k", f"CROSS JOIN b{levels} AS top"]
    for name, start in (("a", "x.i"), ("b", "place.i")):
        for level in range(levels):
            r = f"{name}r{level}"
            key = f"{r}.k = x.k AND " if name == "a" else ""
            joins.append(f"JOIN {name}run{level} AS {r} ON {key}{r}.i = {start} // {16**level}")
            proof.append(f"CASE WHEN {r}.n = 1 THEN '' ELSE {around.format(r=r)} END")
            folds.append(r)
    wide = ", ".join(f"{r}.n AS {r}n, {r}.run AS {r}run, {r}.i AS {r}i" for r in folds)
    parts.append(
        f"f0 AS (SELECT x.doc_id, x.leaf, sub.h AS subroot, top.h AS root, sha256({' || '.join(proof)}) AS proof_sha256, "
        f"x.claimed AS folded, {wide} FROM leaves x {' '.join(joins)})"
    )
    for n, r in enumerate(folds):
        cut = f"64 * CAST({r}i % 16 AS BIGINT)"
        folded = f"CASE WHEN {r}n = 1 THEN folded ELSE sha256(substr({r}run, 1, {cut}) || folded || substr({r}run, {cut} + 65)) END"
        parts.append(f"f{n + 1} AS (SELECT * REPLACE ({folded} AS folded) FROM f{n})")
    return (
        f"WITH {', '.join(parts)} SELECT doc_id, leaf, subroot, root, proof_sha256, folded AS folded_root, folded = root AS verified FROM f{len(folds)}"
    )


def collocations(least: int = 30, top: int = 2000, covered: int = 80) -> str:
    """All phrases by joins of words with the words after them in their piece; HUGEINT where products need it."""
    grams = ["SELECT lang, 1 AS k, w1 AS phrase FROM runs"]
    for k in range(2, 5):
        grams.append(f"SELECT lang, {k}, {' || chr(32) || '.join(f'w{i}' for i in range(1, k + 1))} FROM runs WHERE w{k} IS NOT NULL")
    parts = "list_aggregate(words[{}], 'string_agg', ' ')"
    inner = " UNION ALL ".join(
        f"SELECT lang, {parts.format(f'{i}:{i + m - 1}')} AS phrase, f FROM cand WHERE k = {k}"
        for k in (3, 4) for m in range(2, k) for i in range(1, k - m + 2)
    )
    cuts = " UNION ALL ".join(
        f"SELECT lang, phrase, f, {c} AS cut, {parts.format(f'1:{c}')} AS lp, {parts.format(f'{c + 1}:k')} AS rp FROM rest WHERE k > {c}" for c in (1, 2, 3)
    )
    return f"""
WITH pieces AS (
    SELECT lang, piece, row_number() OVER () AS p FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({LOWERED.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
words AS (SELECT lang, p, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM (SELECT lang, p, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces)),
runs AS (SELECT lang, w AS w1, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3, lead(w, 3) OVER o AS w4 FROM words WINDOW o AS (PARTITION BY p ORDER BY i)),
totals AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
freq AS (SELECT lang, k, phrase, count(*) AS f FROM ({' UNION ALL '.join(grams)}) GROUP BY lang, k, phrase HAVING count(*) >= {least}),
cand AS (SELECT *, string_split(phrase, ' ') AS words FROM freq WHERE k > 1),
longer AS (SELECT lang, phrase, max(f) AS m FROM ({inner}) GROUP BY lang, phrase),
rest AS (SELECT c.* FROM cand c LEFT JOIN longer l ON l.lang = c.lang AND l.phrase = c.phrase WHERE l.m IS NULL OR 100 * l.m::HUGEINT < {covered} * c.f),
scored AS (
    SELECT c.lang, c.phrase, c.f AS a, x.f AS l, y.f AS r, (2000000 * c.f::HUGEINT) // (x.f + y.f) AS score,
        row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY (2000000 * c.f::HUGEINT) // (x.f + y.f), cut) AS best
    FROM ({cuts}) c JOIN freq x ON x.lang = c.lang AND x.phrase = c.lp JOIN freq y ON y.lang = c.lang AND y.phrase = c.rp),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored WHERE best = 1)
SELECT r.lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked r JOIN totals t ON t.lang = r.lang WHERE rank <= {top}"""
