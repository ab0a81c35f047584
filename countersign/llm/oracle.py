"""Expected results of the operators as SQL for DuckDB, written apart from them."""


def centroids(rounds: int = 10, k: int = 8, dimensions: int = 64) -> str:
    """Every distance to every centroid, and exact floored means, round by round."""
    distance = (
        f"list_sum([CAST(v.q[i] - c.q[i] AS HUGEINT) * (v.q[i] - c.q[i]) FOR i IN range(1, {dimensions + 1})])"
    )
    steps = [
        f"""v AS MATERIALIZED (
          SELECT vec_id, row_number() OVER () AS row_id,
                 [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
          FROM embeddings
          WHERE len(embedding) = {dimensions}
            AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {dimensions})""",
        f"""c0 AS MATERIALIZED (
          SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c, q
          FROM (SELECT * FROM v ORDER BY sha256('3:' || vec_id) LIMIT {k}))""",
    ]
    for turn in range(rounds + 1):
        steps.append(f"""a{turn} AS MATERIALIZED (
          SELECT row_id, min(struct_pack(d := d, c := c)) AS best
          FROM (SELECT v.row_id, c.c, {distance} AS d FROM v, c{turn} AS c) GROUP BY row_id)""")
        if turn == rounds:
            break
        steps.append(f"""m{turn} AS MATERIALIZED (
          SELECT c, list(((s - ((s % n) + n) % n) // n) ORDER BY i) AS q
          FROM (SELECT a.best.c AS c, i, sum(CAST(v.q[i] AS HUGEINT)) AS s, count(*) AS n
                FROM a{turn} AS a JOIN v USING (row_id), range(1, {dimensions + 1}) AS r(i) GROUP BY ALL) GROUP BY c)""")
        steps.append(f"""c{turn + 1} AS MATERIALIZED (
          SELECT c{turn}.c, coalesce(m.q, c{turn}.q) AS q FROM c{turn} LEFT JOIN m{turn} AS m ON m.c = c{turn}.c)""")
    last = f"c{rounds}"
    return f"""WITH {", ".join(steps)}
        SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance,
               CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
               CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string({last}.q, ',')) AS centroid_sha256
        FROM a{rounds} JOIN v USING (row_id) JOIN {last} ON {last}.c = best.c"""


def prefix_trie() -> str:
    """Every beginning of every rebuilt conversation as a list of turns, grouped; subtrees by comparing beginnings."""
    return r"""
        WITH turns AS MATERIALIZED (
          SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos,
                 struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) AS said
          FROM conversations WHERE conv_id IS NOT NULL),
        plan AS (
          SELECT DISTINCT conv_id AS c, conv_id - conv_id % 20 AS base, crc AS h
          FROM (SELECT conv_id, {crc} % 4 AS crc FROM (SELECT DISTINCT conv_id FROM turns))),
        rebuilt AS MATERIALIZED (
          SELECT c, 0 AS part, pos, said FROM plan JOIN turns ON turns.conv_id = base AND pos < h
          UNION ALL SELECT c, 1, pos, said FROM plan JOIN turns ON turns.conv_id = c AND pos >= h),
        paths AS MATERIALIZED (
          SELECT plan.c, coalesce(list(said ORDER BY part, pos) FILTER (WHERE said IS NOT NULL), []) AS path
          FROM plan LEFT JOIN rebuilt ON rebuilt.c = plan.c GROUP BY plan.c),
        beginnings AS MATERIALIZED (
          SELECT c, d, path[1:d] AS path, len(path) = d AS ends FROM paths, range(0, 10000) AS r(d) WHERE d <= len(path)),
        nodes AS MATERIALIZED (
          SELECT min(c) AS conv_id, d AS depth, path, count(*) AS n_convs,
                 sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256,
                 CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(path[d].text, '[^\x20\x09-\x0D]+')) END AS words
          FROM beginnings GROUP BY d, path),
        linked AS MATERIALIZED (
          SELECT n.*, p.conv_id AS parent_conv_id,
                 (SELECT count(*) FROM nodes AS k WHERE k.depth = n.depth + 1 AND k.path[1:n.depth] = n.path) AS n_children
          FROM nodes AS n LEFT JOIN nodes AS p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1])
        SELECT n.conv_id, n.depth, n.parent_conv_id, n.n_convs, n.n_children,
               count(*) FILTER (WHERE u.n_children = 0) AS n_leaves,
               CAST(sum((u.n_convs - 1) * u.words) AS BIGINT) AS saved_tokens, n.ends_sha256
        FROM linked AS n JOIN linked AS u ON u.depth >= n.depth AND u.path[1:n.depth] = n.path
        GROUP BY n.conv_id, n.depth, n.parent_conv_id, n.n_convs, n.n_children, n.ends_sha256, n.path""".replace("{crc}", _crc32("conv_id"))


def _crc32(number: str) -> str:
    """The unsigned CRC-32 of a number's decimal text, bit by bit."""
    text = f"CAST({number} AS VARCHAR)"
    bits = f"flatten([[ord({text}[i]), 0, 0, 0, 0, 0, 0, 0] FOR i IN range(1, len({text}) + 1)])"
    step = "lambda a, v: xor(xor(a, v) >> 1, 3988292384 * (xor(a, v) & 1))"
    return f"xor(list_reduce([CAST(4294967295 AS BIGINT)] || CAST({bits} AS BIGINT[]), {step}), 4294967295)"


def weak_rules(rounds: int = 50) -> str:
    """Statistics by lists of words and lines, votes in long form, and the rounds one after the other."""
    rules = {  # name: bad, good; over the counts
        "a": ("10 * n_symbols > n_words", "50 * n_symbols <= n_words", "n_words"),
        "b": ("word_chars < 3 * n_words OR word_chars > 10 * n_words", "word_chars >= 4 * n_words AND 2 * word_chars <= 13 * n_words", "n_words"),
        "c": ("10 * n_dup_lines > 3 * n_lines", "n_dup_lines = 0 AND n_lines >= 3", "n_lines"),
        "d": ("5 * n_repeat_words > n_words", "50 * n_repeat_words <= n_words", "n_words"),
        "e": ("5 * n_lettered < 4 * n_words", "20 * n_lettered >= 19 * n_words", "n_words"),
        "f": ("10 * n_short < n_words", "5 * n_short >= n_words AND 20 * n_short <= 9 * n_words", "n_words"),
        "g": ("5 * n_upper > n_words", "20 * n_upper <= n_words", "n_words"),
        "h": ("5 * n_ended < 2 * n_lines", "5 * n_ended >= 4 * n_lines", "n_lines"),
        "i": ("5 * n_distinct < n_words", "2 * n_distinct >= n_words", "n_words"),
    }
    votes = " UNION ALL ".join(
        f"SELECT row_id, failed, '{name}' AS rule, CASE WHEN {base} = 0 THEN 0 WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END AS vote FROM counts"
        for name, (bad, good, base) in rules.items()
    )
    steps = [
        r"""texts AS MATERIALIZED (
          SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS t FROM documents)""",
        r"""lists AS MATERIALIZED (
          SELECT row_id, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
                 [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines FROM texts)""",
        r"""windows AS MATERIALIZED (
          SELECT row_id, i, count(*) OVER (PARTITION BY row_id, a, b, c) AS often FROM (
            SELECT row_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
            FROM (SELECT row_id, w, unnest(range(1, len(w) - 1)) AS i FROM lists)))""",
        """repeats AS (
          SELECT row_id, count(DISTINCT i + k) AS n FROM windows, range(3) AS r(k) WHERE often > 1 GROUP BY row_id)""",
        r"""counts AS MATERIALIZED (
          SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS failed FROM (
            SELECT row_id, doc_id, len(w) AS n_words, CAST(coalesce(list_sum([length(x) FOR x IN w]), 0) AS BIGINT) AS word_chars,
                   len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                   coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines,
                   len([x FOR x IN lines IF regexp_matches(x, '[.!?:;")…»”][\\x20\\x09-\\x0D]*$')]) AS n_ended,
                   len([x FOR x IN w IF regexp_matches(x, '\\p{L}')]) AS n_lettered,
                   len([x FOR x IN w IF length(x) <= 3]) AS n_short,
                   len([x FOR x IN w IF regexp_matches(x, '\\p{L}.*\\p{L}') AND regexp_matches(x, '\\p{Lu}') AND NOT regexp_matches(x, '\\p{Ll}')]) AS n_upper,
                   len(list_distinct(w)) AS n_distinct
            FROM lists LEFT JOIN repeats USING (row_id)))""".replace("\\\\", "\\"),
        f"votes AS MATERIALIZED ({votes})",
        """shapes AS MATERIALIZED (
          SELECT row_id, failed, string_agg(vote, ',' ORDER BY rule) AS shape FROM votes GROUP BY row_id, failed)""",
        "fitted AS MATERIALIZED (SELECT shape, count(*) AS n FROM shapes WHERE NOT failed GROUP BY shape)",
        """cast_votes AS MATERIALIZED (
          SELECT DISTINCT shape, rule, vote FROM shapes JOIN votes USING (row_id))""",
        f"""start AS MATERIALIZED (
          SELECT class, rule, vote, p FROM (VALUES (0, -1, 0.3::DOUBLE), (0, 0, 0.2), (0, 1, 0.5), (1, -1, 0.02), (1, 0, 0.18), (1, 1, 0.8)) AS s(class, vote, p),
               (VALUES {", ".join(f"('{r}')" for r in rules)}) AS r(rule))""",
        "t0 AS MATERIALIZED (SELECT * FROM start)",
        "g0 AS MATERIALIZED (SELECT 0.8::DOUBLE AS good)",
    ]

    def odds(turn: int) -> str:
        return f"""SELECT c.shape, ln(any_value(good)) - ln(1 - any_value(good)) + sum(CASE WHEN class = 1 THEN ln(p) ELSE -ln(p) END) AS odds
          FROM cast_votes AS c JOIN t{turn} AS t ON t.rule = c.rule AND t.vote = c.vote, g{turn} GROUP BY c.shape"""

    for turn in range(rounds):
        steps += [
            f"q{turn} AS MATERIALIZED (SELECT shape, n, 1 / (1 + exp(-odds)) AS q FROM fitted JOIN ({odds(turn)}) USING (shape))",
            f"""s{turn} AS MATERIALIZED (
              SELECT s.class, s.rule, s.vote, 10 * s.p + coalesce(seen, 0) AS w FROM start AS s LEFT JOIN (
                SELECT class, rule, vote, sum(n * CASE WHEN class = 1 THEN q ELSE 1 - q END) AS seen
                FROM q{turn} JOIN cast_votes USING (shape), (VALUES (0), (1)) AS k(class) GROUP BY ALL
              ) AS o ON o.class = s.class AND o.rule = s.rule AND o.vote = s.vote)""",
            f"t{turn + 1} AS MATERIALIZED (SELECT class, rule, vote, w / sum(w) OVER (PARTITION BY class, rule) AS p FROM s{turn})",
            f"g{turn + 1} AS MATERIALIZED (SELECT (coalesce(sum(n * q), 0) + 8) / (coalesce(sum(n), 0) + 10) AS good FROM q{turn})",
        ]
    return f"""WITH {", ".join(steps)}
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, counts.failed AS base_failed,
               NOT counts.failed AND odds >= 0 AS kept
        FROM counts JOIN shapes USING (row_id) JOIN ({odds(rounds)}) USING (shape)"""
