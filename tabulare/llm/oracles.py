"""SQL counterparts, for an independent engine, of the operators that SQL can express."""

from __future__ import annotations

from tabulare.llm import license, merkle, mixing, quality


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


EXACT = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""


def _license() -> str:
    rows = []
    for name, body in license.TEMPLATES:
        grams = license.bigrams(license.word_list(body))
        rows.append(f"({_text(name)}, [{', '.join(map(_text, grams))}])")
    return f"""
    WITH templates(name, grams) AS (VALUES {", ".join(rows)}),
    units AS (
      SELECT doc_id, unnest(list_distinct(list_concat(
        string_split(coalesce(text, ''), chr(10)),
        string_split_regex(coalesce(text, ''), '[.!?][\\x20\\x09-\\x0D]+'),
        string_split_regex(coalesce(text, ''), '\\n[\\x20\\x09-\\x0D]*\\n')))) AS u
      FROM documents),
    cut AS (
      SELECT doc_id, string_split(lower(trim(regexp_replace(u, '[^A-Za-z0-9]+', ' ', 'g'))), ' ') AS w FROM units),
    sets AS (
      SELECT doc_id, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM cut),
    scored AS (
      SELECT doc_id, g, name,
        len(list_intersect(g, grams)) * 2.0::DOUBLE / (len(g) + len(grams)) AS score
      FROM sets, templates WHERE len(g) > 0),
    places AS (
      SELECT doc_id, max({{'score': score, 'name': name}}) AS m
      FROM scored WHERE score >= {license.MIN_SCORE}::DOUBLE GROUP BY doc_id, g),
    matched AS (SELECT doc_id, m.name AS name, max(m.score) AS score FROM places GROUP BY doc_id, m.name),
    best AS (
      SELECT doc_id, count(*) AS n, max({{'score': score, 'name': name}}) AS top,
        array_to_string(list_sort(list_distinct(list(name))), ',') AS names
      FROM matched GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n, 0) AS n_matches, top.name AS license, top.score AS score, coalesce(names, '') AS names
    FROM documents d LEFT JOIN best USING (doc_id)
    """


def _quality() -> str:
    values = [
        f"CASE WHEN {under} > 0 THEN {over}::DOUBLE / {under} ELSE 0 END"
        for over, under in (share.split(" / ") for share, _ in quality.RULES.values())
    ]
    steps = ", ".join(
        f"CASE WHEN {value} > {cutoff}::DOUBLE THEN {level * len(quality.RULES) + rule} ELSE {quality.STEPS} END"
        for rule, (value, (_, cutoffs)) in enumerate(zip(values, quality.RULES.values(), strict=True))
        for level, cutoff in enumerate(cutoffs)
    )
    rate = f"{quality.FALSE_REJECTIONS}::DOUBLE"
    return f"""
    WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
    cut AS (
      SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
        list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
    windows AS (
      SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM cut)),
    again AS (SELECT doc_id, i FROM (
      SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM windows) WHERE n > 1),
    covered AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM again, range(3) AS r(j) GROUP BY doc_id),
    f AS (
      SELECT cut.doc_id, lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_lines,
        len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
      FROM cut LEFT JOIN covered ON cut.doc_id = covered.doc_id),
    v AS (SELECT *, least({steps}) AS step FROM f),
    marked AS (SELECT doc_id, max(quality > 0) AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
    labelled AS (
      SELECT doc_id, arg_min(lang, (step, lang)) AS lang, any_value(good) AS good, min(step) AS step
      FROM v JOIN marked USING (doc_id) GROUP BY doc_id),
    good AS (SELECT *, count(*) OVER () AS strata FROM (
      SELECT lang, count(*) FILTER (WHERE good) AS n FROM labelled GROUP BY lang) WHERE n > 0),
    seen AS (
      SELECT good.lang, n, strata, t,
        count(*) FILTER (WHERE good AND step <= t) AS k, count(*) FILTER (WHERE NOT good AND step <= t) AS bad
      FROM labelled JOIN good ON labelled.lang IS NOT DISTINCT FROM good.lang, range({quality.STEPS}) AS r(t) GROUP BY ALL),
    tested AS (
      SELECT *, strata * CASE WHEN k < n * {rate} THEN (
        SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({rate}) + (n - i) * ln(1 - {rate})))
        FROM range(k + 1) AS r(i)) ELSE 1 END > {quality.ERROR}::DOUBLE AS unsafe FROM seen),
    chosen AS (
      SELECT lang, arg_max(t, (bad, -t)) AS most FROM (
        SELECT *, max(unsafe) OVER (PARTITION BY lang ORDER BY t) AS over FROM tested) WHERE NOT over GROUP BY lang),
    failed AS (
      SELECT DISTINCT v.doc_id FROM v JOIN chosen ON v.lang IS NOT DISTINCT FROM chosen.lang WHERE step <= most)
    SELECT v.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
      n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed,
      NOT base_failed AND failed.doc_id IS NULL AS kept
    FROM v LEFT JOIN failed ON v.doc_id = failed.doc_id
    """


MIXING_TABLES = f"""
    celled AS (
      SELECT *, coalesce('=' || source, '') AS s, md5(coalesce(doc_id::VARCHAR, '')) AS digest FROM docs),
    placed AS (
      SELECT *, ('0x' || substr(digest, 1, 8))::BIGINT % {mixing.CELLS} AS cell FROM celled),
    numbered AS (
      SELECT *, row_number() OVER (PARTITION BY s ORDER BY cell, digest, doc_id) - 1 AS num FROM placed),
    sizes AS (
      SELECT s, sqrt(count(*)) AS w, (count(*) + {mixing.BLOCK_ROWS} - 1) // {mixing.BLOCK_ROWS} AS blocks FROM celled GROUP BY s),
    scaled AS (SELECT *, CASE WHEN count(*) FILTER (w <> floor(w)) OVER () > 0 OR sum(w) OVER () > {mixing.PARTS}
      THEN {mixing.PARTS}::DOUBLE / sum(w) OVER () ELSE 1 END AS scale FROM sizes),
    whole AS (SELECT s, blocks, greatest(round(w * scale)::HUGEINT, 1) AS q FROM scaled),
    jobs AS (
      SELECT s, i, (i * total // q)::BIGINT AS release, (((i + 1) * total + q - 1) // q)::BIGINT AS deadline
      FROM (SELECT s, q, sum(q) OVER ()::HUGEINT AS total, unnest(range(blocks))::HUGEINT AS i, FROM whole)),
    todo AS (SELECT list({{'d': deadline, 's': s, 'i': i::BIGINT, 'r': release}}) AS rest FROM jobs),
    run AS (
      SELECT -1::BIGINT AS slot, NULL::STRUCT(d BIGINT, s VARCHAR, i BIGINT, r BIGINT) AS job, rest FROM todo
      UNION ALL
      SELECT slot, job, list_filter(rest, lambda x: x <> job) FROM (
        SELECT slot, rest, list_aggregate(list_filter(rest, lambda x: x.r <= slot), 'min') AS job FROM (
          SELECT greatest(slot + 1, list_aggregate(list_transform(rest, lambda x: x.r), 'min')) AS slot, rest
          FROM run WHERE len(rest) > 0))),
    blocks AS (SELECT *, num // {mixing.BLOCK_ROWS} AS block FROM numbered),
    mixed AS (
      SELECT b.*, j.release, j.deadline, run.slot, run.slot * {mixing.BLOCK_ROWS} + num % {mixing.BLOCK_ROWS} AS position
      FROM blocks b JOIN jobs j ON b.s = j.s AND b.block = j.i JOIN run ON b.s = run.job.s AND b.block = run.job.i)
"""
MIXING = f"""
    WITH RECURSIVE docs AS (SELECT doc_id, source FROM documents), {MIXING_TABLES}
    SELECT doc_id, source, block, release, deadline, slot::BIGINT AS slot, position::BIGINT AS position FROM mixed
"""

MERKLE_LEVELS = (8, 5)  # 16 ** 8 rows a source and 16 ** 5 sources at most


def _merkle() -> str:
    """Each level over the one before, then each row's way up, level by level, with what stands beside it."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]

    def leaf(text: str) -> str:
        values = [(text if name == "text" else f"{name}::VARCHAR") for name in fields]
        return "sha256(concat(" + ", ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + "))"

    crc = (
        "xor(4294967295::BIGINT, list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT), "
        "lambda crc, c: list_reduce(list_concat([xor(crc, c)], range(8)), "
        "lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END), 4294967295::BIGINT))"
    )
    lower = f"translate(text, '{merkle.LETTERS}', '{merkle.LETTERS.lower()}')"
    steps, ways = [], []
    for tree, count in (("s", MERKLE_LEVELS[0]), ("r", MERKLE_LEVELS[1])):
        steps.append(
            "s0 AS (SELECT s AS t, i, leaf AS d, n FROM placed)" if tree == "s"
            else f"r0 AS (SELECT '' AS t, row_number() OVER (ORDER BY t) - 1 AS i, d, count(*) OVER () AS n, t AS s FROM "
            f"({' UNION ALL '.join(f'SELECT t, d FROM s{k} WHERE n = 1' for k in range(MERKLE_LEVELS[0] + 1))}))"
        )
        for k in range(1, count + 1):
            steps.append(
                f"{tree}{k} AS (SELECT t, i // 16 AS i, sha256(array_to_string(list(d ORDER BY i), '')) AS d, "
                f"(any_value(n) + 15) // 16 AS n, list(d ORDER BY i) AS m FROM {tree}{k - 1} WHERE n > 1 GROUP BY t, i // 16)"
            )
    ways.append("w0 AS (SELECT *, changed AS h, '' AS proof, s AS t FROM placed)")
    at = 0
    for tree, count in (("s", MERKLE_LEVELS[0]), ("r", MERKLE_LEVELS[1])):
        if tree == "r":
            ways.append(
                f"w{at + 1} AS (SELECT w.* REPLACE ('' AS t, r0.i AS i), r0.d AS subroot FROM w{at} w JOIN r0 ON w.s = r0.s)"
            )
            at += 1
        for k in range(1, count + 1):
            left = "coalesce(array_to_string(list_slice(m, 1, w.i % 16), ''), '')"
            right = "coalesce(array_to_string(list_slice(m, w.i % 16 + 2, 16), ''), '')"
            ways.append(
                f"w{at + 1} AS (SELECT w.* REPLACE (w.i // 16 AS i, CASE WHEN m IS NULL THEN h ELSE sha256({left} || h || {right}) END AS h, "
                f"CASE WHEN m IS NULL THEN proof ELSE proof || {left} || {right} END AS proof) "
                f"FROM w{at} w LEFT JOIN {tree}{k} u ON w.t = u.t AND w.i // 16 = u.i)"
            )
            at += 1
    root = " UNION ALL ".join(f"SELECT d FROM r{k} WHERE n = 1" for k in range(MERKLE_LEVELS[1] + 1))
    return f"""
    WITH leaves AS (
      SELECT doc_id, coalesce('=' || source, '') AS s, {leaf("text")} AS leaf,
        CASE WHEN {crc} % 5 = 0 THEN {leaf(lower)} ELSE {leaf("text")} END AS changed FROM documents),
    placed AS (
      SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
        count(*) OVER (PARTITION BY s) AS n FROM leaves),
    {", ".join(steps)}, {", ".join(ways)}, root AS ({root})
    SELECT doc_id, leaf, subroot, root.d AS root, sha256(proof) AS proof_sha256, h AS folded_root, h = root.d AS verified
    FROM w{at}, root
    """


LLM_ORACLES: dict[str, str] = {
    "op4_exact_dedup": EXACT,
    "op6_license_scan": _license(),
    "op9_quality_rules": _quality(),
    "op10_mix_sources": MIXING,
    "op12_merkle_manifest": _merkle(),
}
