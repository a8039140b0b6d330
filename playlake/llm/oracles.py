"""SQL that gives the rows of the queries it can express."""

from __future__ import annotations


def centroid_rounds(rounds: int, k: int) -> str:
    """Assignments and means in turn, one common table expression for each."""
    apart = "list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    steps = []
    for i in range(rounds + 1):
        steps.append(
            f"a{i} AS (SELECT r, any_value(v.vec_id) AS vec_id, any_value(v.x) AS x,"
            f" min(struct_pack(d := CAST({apart} AS BIGINT), c := c.c)) AS near FROM kept v CROSS JOIN c{i} c GROUP BY r)"
        )
        if i < rounds:
            # Division of whole numbers cuts towards zero; the remainder is taken off first, so it is exact.
            steps.append(
                f"m{i} AS (SELECT near.c AS c, j, sum(x[j]) AS s, count(*) AS n FROM a{i}, range(1, 65) t(j) GROUP BY near.c, j),"
                f" c{i + 1} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS x FROM m{i} GROUP BY c"
                f" UNION ALL SELECT c, x FROM c{i} WHERE c NOT IN (SELECT c FROM m{i}))"
            )
    return (
        "WITH kept AS (SELECT row_number() OVER () AS r, vec_id,"
        " list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings"
        " WHERE len(embedding) = 64 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),"
        " ranked AS (SELECT row_number() OVER (ORDER BY sha256(concat('1:', vec_id)), x) - 1 AS c, x FROM kept),"
        f" c0 AS (SELECT c, x FROM ranked WHERE c < {k}), " + ", ".join(steps) + f" SELECT vec_id, CAST(near.c AS INT) AS cluster, near.d AS distance,"
        " CAST(sum(near.d) OVER (PARTITION BY near.c) AS BIGINT) AS cluster_inertia, CAST(sum(near.d) OVER () AS BIGINT) AS inertia,"
        f" sha256(array_to_string(c.x, ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} c ON c.c = near.c"
    )



def turn_repair() -> str:
    """Damage, faults and a row-by-row search for the least (cost, audit) of each state; a state is null if nothing leads to it."""
    # Checksum of a text of ASCII signs, bit by bit.
    bits = "list_reduce(list_prepend(xor(s, b), range(8)), lambda v, i: xor(v >> 1, (v & 1) * 3988292384))"
    signs = "list_transform(string_split(concat(conv, ':', turn_), ''), lambda c: CAST(ascii(c) AS BIGINT))"
    checksum = f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {signs}), lambda s, b: {bits}), 4294967295)"

    def step(state: str, cost: str, letter: str, line: str | None = None) -> str:
        lines = f"list_append({state}.t, {line})" if line else f"{state}.t"
        return f"CASE WHEN {state} IS NOT NULL THEN struct_pack(c := {state}.c + {cost}, a := {state}.a || '{letter}', t := {lines}) END"

    def least(*states: str) -> str:
        return f"list_sort([{', '.join(states)}], 'ASC', 'NULLS LAST')[1]"

    def kept(state: str, initial: str) -> str:
        return f"CASE WHEN r.initial = '{initial}' AND r.fault < 2 THEN {step(state, 'r.fault', 'K', 'r.line')} END"

    def given(state: str, role: str) -> str:
        return f"CASE WHEN r.fault < 2 THEN {step(state, '2 + r.fault', 'R', f"concat('{role}:', r.text)")} END"

    def inserted(columns: str, source: str) -> str:
        to_user = least("su", step("s0", "2", "I", "'user:'"), step("ss", "2", "I", "'user:'"), step("sa", "2", "I", "'user:'"))
        to_assistant = least("sa", step("uu", "2", "I", "'assistant:'"))
        return f"SELECT {columns}, s0, ss, uu, {to_assistant} AS aa FROM (SELECT *, {to_user} AS uu FROM {source})"

    from_three = [f(s, x) for f, x in ((kept, "u"), (given, "user")) for s in ("p.s0", "p.ss", "p.aa")]
    user = least(step("p.uu", "3", "D"), *from_three)
    assistant = least(step("p.aa", "3", "D"), kept("p.uu", "a"), given("p.uu", "assistant"))
    return f"""WITH RECURSIVE shown AS (
            SELECT conv_id, turn, coalesce(CAST(conv_id AS VARCHAR), ' ') AS conv, coalesce(CAST(turn AS VARCHAR), ' ') AS turn_,
                coalesce(role, ' ') AS role, coalesce(text, ' ') AS text FROM conversations),
        lots AS (SELECT *, {checksum} % 20 AS lot FROM shown),
        damaged AS (
            SELECT conv_id, turn, CASE WHEN lot = 4 THEN 'user' ELSE role END AS role,
                CASE lot WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
            FROM lots, range(2) t(copy) WHERE lot <> 0 AND (copy = 0 OR lot = 3)),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, left(role, 16), md5(concat(length(role), ':', role, text))) AS i,
                rtrim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS bare FROM damaged),
        judged AS (
            SELECT *, bare = '' AS blank, bare <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS duplicate FROM placed),
        rows AS (
            SELECT conv_id, i, turn, text, blank, duplicate, left(role, 1) AS initial, concat(role, ':', text) AS line,
                NOT blank AND NOT duplicate AND right(bare, 1) NOT IN ('.', '!', '?') AS truncated,
                CASE WHEN blank OR duplicate THEN 2 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS fault,
                concat(left(role, 1), '>', lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i)) AS pair,
                lead(1) OVER (PARTITION BY conv_id ORDER BY i) AS more
            FROM judged),
        states AS (
            SELECT conv_id, CAST(0 AS BIGINT) AS i, struct_pack(c := CAST(0 AS INT), a := '', t := CAST([] AS VARCHAR[])) AS s0,
                CAST(NULL AS STRUCT(c INT, a VARCHAR, t VARCHAR[])) AS ss, CAST(NULL AS STRUCT(c INT, a VARCHAR, t VARCHAR[])) AS su,
                CAST(NULL AS STRUCT(c INT, a VARCHAR, t VARCHAR[])) AS sa
            FROM rows WHERE i = 1
            UNION ALL
            SELECT p.conv_id, r.i, {step("p.s0", "3", "D")}, {least(step("p.ss", "3", "D"), kept("p.s0", "s"))}, {user}, {assistant}
            FROM ({inserted("conv_id, i", "states")}) p JOIN rows r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i + 1),
        per AS (
            SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
                count(*) FILTER (more = 1 AND pair NOT IN ('s>u', 'u>a', 'a>u')) AS illegal
            FROM rows GROUP BY conv_id),
        ended AS (SELECT conv_id, i, {least("s0", "aa")} AS won FROM ({inserted("conv_id, i", "states")})),
        every AS (SELECT DISTINCT conv_id FROM conversations)
        SELECT v.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
            coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(e.won.c, 0) AS BIGINT) AS cost,
            coalesce(e.won.a, '') AS audit, sha256(coalesce(array_to_string(e.won.t, chr(10)), '')) AS repaired_sha256
        FROM every v LEFT JOIN per p ON p.conv_id IS NOT DISTINCT FROM v.conv_id
        LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM v.conv_id AND e.i = p.n"""


ORACLES = {"op11_turn_repair": turn_repair(), "op12_zone_clusters": centroid_rounds(3, 16)}
