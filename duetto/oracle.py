"""DuckDB oracle SQL for the registered queries (see ``duetto.catalog``).

The tables of the driver are views named after them.  Iterative plans are
written as recursive CTEs that run the same rounds as the Spark plans.
"""

from __future__ import annotations


def _market(hospital_order: str) -> str:
    return f"""
g AS (SELECT o_custkey AS doctor_id, l_suppkey AS hospital_id,
             sum(l_quantity) AS qty, max(l_extendedprice) AS top_price
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
edges AS (SELECT doctor_id, hospital_id,
          row_number() OVER (PARTITION BY doctor_id ORDER BY qty DESC, hospital_id) AS doctor_rank,
          row_number() OVER (PARTITION BY hospital_id ORDER BY {hospital_order}, doctor_id) AS hospital_rank
          FROM g)"""


MARKET = _market("top_price DESC")
CONTESTED = _market("qty ASC")

# Round 1 of doctor-proposing deferred acceptance (an unstable matching).
STATE = """
prop AS (SELECT * FROM edges WHERE doctor_rank = 1),
ranked_prop AS (SELECT *, row_number() OVER (PARTITION BY hospital_id ORDER BY hospital_rank) AS pos
                FROM prop),
state AS (SELECT doctor_id, hospital_id, doctor_rank, hospital_rank FROM ranked_prop WHERE pos <= 6)"""

# Round 2 with 20 places: whom a supplier refused proposes to its second choice.
STATE2 = """
prop1 AS (SELECT * FROM edges WHERE doctor_rank = 1),
rp1 AS (SELECT *, row_number() OVER (PARTITION BY hospital_id ORDER BY hospital_rank) AS pos FROM prop1),
prop2 AS (SELECT doctor_id, hospital_id, doctor_rank, hospital_rank FROM rp1 WHERE pos <= 20
          UNION ALL
          SELECT e.doctor_id, e.hospital_id, e.doctor_rank, e.hospital_rank
          FROM edges e JOIN rp1 r USING (doctor_id) WHERE r.pos > 20 AND e.doctor_rank = 2),
rp2 AS (SELECT *, row_number() OVER (PARTITION BY hospital_id ORDER BY hospital_rank) AS pos FROM prop2),
state AS (SELECT doctor_id, hospital_id, doctor_rank, hospital_rank FROM rp2 WHERE pos <= 20)"""

# Quotas of 0 to 8 places, null for some suppliers and none for others.
QUOTAS = """
qt AS (SELECT s_suppkey AS hospital_id, CASE WHEN s_suppkey % 10 <> 8 THEN s_suppkey % 9 END AS q
       FROM supplier WHERE s_suppkey % 10 <> 9),
caps AS (SELECT hospital_id, greatest(coalesce(q, 0), 0) AS cap FROM qt)"""

# Hospital-optimal rounds: offers = top 6 per hospital, doctors keep the best,
# edges below a doctor's best offer are deleted; stop when nothing is deleted.
I2 = """
a2(it, doctor_id, hospital_id, doctor_rank, hospital_rank, offer, best, removed) AS (
  SELECT 0, doctor_id, hospital_id, doctor_rank, hospital_rank, false, 1000000000::BIGINT, 1::HUGEINT
  FROM edges
  UNION ALL
  SELECT it + 1, doctor_id, hospital_id, doctor_rank, hospital_rank, o2, best2,
         sum(CASE WHEN doctor_rank > best2 THEN 1 ELSE 0 END) OVER ()
  FROM (SELECT *, coalesce(min(CASE WHEN o2 THEN doctor_rank END) OVER (PARTITION BY doctor_id),
                           1000000000) AS best2
        FROM (SELECT it, doctor_id, hospital_id, doctor_rank, hospital_rank,
                     row_number() OVER (PARTITION BY hospital_id ORDER BY hospital_rank) <= 6 AS o2
              FROM a2 WHERE removed > 0 AND doctor_rank <= best) x) y),
i2 AS (SELECT doctor_id, hospital_id, doctor_rank, hospital_rank FROM a2
       WHERE it = (SELECT max(it) FROM a2) AND offer AND doctor_rank = best)"""

# Doctor-optimal rounds with acceleration: proposals = best remaining edge,
# a hospital with 6 proposals deletes every edge below its 6th.
I1 = """
a1(it, doctor_id, hospital_id, doctor_rank, hospital_rank, o, held, kept, removed) AS (
  SELECT 0, doctor_id, hospital_id, doctor_rank, hospital_rank, false, false, true, 1::HUGEINT
  FROM edges
  UNION ALL
  SELECT it + 1, doctor_id, hospital_id, doctor_rank, hospital_rank, o2, o2 AND rn <= 6, k2,
         sum(CASE WHEN k2 THEN 0 ELSE 1 END) OVER ()
  FROM (SELECT *, cut IS NULL OR hospital_rank <= cut AS k2
        FROM (SELECT *, max(CASE WHEN o2 AND rn = 6 THEN hospital_rank END)
                          OVER (PARTITION BY hospital_id) AS cut
              FROM (SELECT *, row_number() OVER (PARTITION BY hospital_id, o2 ORDER BY hospital_rank) AS rn
                    FROM (SELECT it, doctor_id, hospital_id, doctor_rank, hospital_rank,
                                 row_number() OVER (PARTITION BY doctor_id ORDER BY doctor_rank) = 1 AS o2
                          FROM a1 WHERE removed > 0 AND kept) x) y) z) w),
i1 AS (SELECT doctor_id, hospital_id, doctor_rank, hospital_rank FROM a1
       WHERE it = (SELECT max(it) FROM a1) AND o)"""

TRACE2 = """
m2 AS (SELECT it, doctor_id, hospital_id FROM a2 WHERE offer AND doctor_rank = best),
c2 AS (SELECT x.it, count(*) FILTER (WHERE y.hospital_id IS NULL OR y.hospital_id <> x.hospital_id) AS n
       FROM m2 x LEFT JOIN m2 y ON y.doctor_id = x.doctor_id AND y.it = x.it - 1 GROUP BY 1),
t2 AS (SELECT it::BIGINT AS iteration, n::BIGINT AS n_changes FROM c2
       UNION ALL SELECT (it + 1)::BIGINT, 0::BIGINT FROM c2 WHERE it = (SELECT max(it) FROM c2) AND n > 0)"""

TRACE1 = """
m1 AS (SELECT it, doctor_id, hospital_id FROM a1 WHERE held),
its1 AS (SELECT DISTINCT it FROM a1 WHERE it >= 1),
prv1 AS (SELECT it + 1 AS it, doctor_id, hospital_id FROM m1),
ch1 AS (SELECT coalesce(x.it, y.it) AS it
        FROM m1 x FULL JOIN prv1 y ON x.it = y.it AND x.doctor_id = y.doctor_id
        WHERE x.hospital_id IS DISTINCT FROM y.hospital_id),
c1 AS (SELECT its1.it, count(ch1.it) AS n FROM its1 LEFT JOIN ch1 ON ch1.it = its1.it GROUP BY 1),
t1 AS (SELECT it::BIGINT AS iteration, n::BIGINT AS n_changes FROM c1
       UNION ALL SELECT (it + 1)::BIGINT, 0::BIGINT FROM c1 WHERE it = (SELECT max(it) FROM c1) AND n > 0)"""

EDGE_SELECT = """doctor_id::BIGINT AS doctor_id, hospital_id::BIGINT AS hospital_id,
doctor_rank::BIGINT AS doctor_rank, hospital_rank::BIGINT AS hospital_rank"""

# The same rounds with the column q of a quota table in place of 6.
_Q_EDGES = "edges AS (SELECT e.*, cap AS q FROM all_edges e JOIN caps USING (hospital_id) WHERE cap >= 1)"


def _quota_market(market: str) -> str:
    return market.replace("edges AS (SELECT", "all_edges AS (SELECT") + "," + QUOTAS + "," + _Q_EDGES


def _with_q(rounds: str, name: str) -> str:
    return (rounds.replace("<= 6", "<= q").replace("rn = 6", "rn = q")
            .replace("hospital_rank, o", "hospital_rank, q, o").replace("hospital_rank, false", "hospital_rank, q, false")
            .replace("doctor_rank, hospital_rank,\n", "doctor_rank, hospital_rank, q,\n"))


def _blocking(cap: str = "6", edges: str = "edges") -> str:
    """Blocking pairs of a matching "mt" (free place, or ranked above the worst held)."""
    return f"""
md AS (SELECT doctor_id, doctor_rank AS mdr FROM mt),
mh AS (SELECT hospital_id, count(*) AS fill, max(hospital_rank) AS worst FROM mt GROUP BY 1),
bp AS (SELECT e.* FROM {edges} e LEFT JOIN md USING (doctor_id) LEFT JOIN mh USING (hospital_id)
       {"LEFT JOIN caps USING (hospital_id)" if cap != "6" and cap != "20" else ""}
       WHERE (md.mdr IS NULL OR e.doctor_rank < md.mdr) AND {cap} > 0
         AND (coalesce(mh.fill, 0) < {cap} OR e.hospital_rank < mh.worst))"""


BLOCKING = _blocking()
CAP = "coalesce(cap, 0)"


def _consistency(mt: str, over: str, label: str | None = None) -> str:
    """The consistency row of a matching; ``over`` selects the hospitals over their quota."""
    tail = f", '{label}' AS matching" if label else ""
    return f"""
SELECT (SELECT count(*) FROM {mt})::BIGINT AS n_filled,
       (SELECT max(c) FROM (SELECT count(*) AS c FROM {mt} GROUP BY hospital_id))::BIGINT AS max_fill,
       ({over})::BIGINT AS n_over_quota,
       (SELECT count(DISTINCT doctor_id) FROM {mt})::BIGINT AS n_matched_doctors,
       (SELECT max(c) FROM (SELECT count(*) AS c FROM {mt} GROUP BY doctor_id))::BIGINT AS max_per_doctor,
       (SELECT count(*) FROM {mt} ANTI JOIN edges USING (doctor_id, hospital_id))::BIGINT AS n_not_edges,
       (SELECT count(*) FROM {mt}) = (SELECT count(DISTINCT doctor_id) FROM {mt})
         AND (SELECT max(c) FROM (SELECT count(*) AS c FROM {mt} GROUP BY doctor_id)) <= 1
         AND ({over}) = 0
         AND (SELECT count(*) FROM {mt} ANTI JOIN edges USING (doctor_id, hospital_id)) = 0
         AS consistent{tail}"""


def _over_six(mt: str) -> str:
    return f"SELECT count(*) FROM (SELECT count(*) AS c FROM {mt} GROUP BY hospital_id) WHERE c > 6"

# Synthetic market hash (same arithmetic as duetto.sources.synth.mix).
def _mix(x: str, salt: int) -> str:
    p = 2147483647
    a = f"(({x}) % {p})"
    b = f"(({a} * 48271 + {salt}) % {p})"
    c = f"(({b} * {b} + 12345) % {p})"
    return f"(({c} * 16807 + {salt}) % {p})"


def _pair_mix(a: str, b: str, salt: int) -> str:
    return _mix(f"{_mix(a, salt)} + 1000003 * (({b}) % 2147483647)", salt)


_DRAWS = f"""
draws AS (SELECT c_custkey AS doctor_id, t.i AS i,
                 {_pair_mix("c_custkey", "t.i", 42)} % (SELECT count(*) FROM supplier) AS hospital_id
          FROM customer, range(0, 10) t(i)),"""

# Without replacement: a walk through the numbers below the next prime.
_DISTINCT_DRAWS = f"""
nh AS (SELECT count(*) AS n FROM supplier),
prime AS (SELECT min(x) AS p FROM range(2, 2 * (SELECT n FROM nh) + 4) r(x), nh
          WHERE x >= n AND NOT EXISTS (SELECT 1 FROM range(2, 2 * (SELECT n FROM nh) + 4) f(y)
                                       WHERE y * y <= x AND x % y = 0)),
walk AS (SELECT c_custkey AS doctor_id, t.j AS j,
                ({_mix("c_custkey", 42)} % p + ({_mix("c_custkey", 44)} % greatest(1, p - 1) + 1) * t.j) % p
                  AS hospital_id
         FROM customer, prime, nh, range(0, 20 + 2 * (SELECT n FROM nh)) t(j)
         WHERE t.j < least(10, n) + p - n),
draws AS (SELECT doctor_id, hospital_id, i FROM (
            SELECT doctor_id, hospital_id, row_number() OVER (PARTITION BY doctor_id ORDER BY j) - 1 AS i
            FROM walk, nh WHERE hospital_id < n) WHERE i < (SELECT least(10, n) FROM nh)),"""

_SYNTH = f"""
sp AS (SELECT doctor_id, hospital_id, min(i) AS doctor_rank FROM draws GROUP BY 1, 2),
edges AS (SELECT doctor_id, hospital_id, doctor_rank,
                 row_number() OVER (PARTITION BY hospital_id ORDER BY
                   {_pair_mix("doctor_id", "hospital_id", 43)}, doctor_id) - 1
                   AS hospital_rank
          FROM sp)"""

SYNTH, DISTINCT_SYNTH = _DRAWS + _SYNTH, _DISTINCT_DRAWS + _SYNTH

# One round of the budgeted loop: who applies (at or above the match of round
# r - 1), the knapsack's table forward, the chosen items backward from the first
# column of the largest value (an item that ties is taken), and the best acceptance.
TERMS = """
terms AS MATERIALIZED (SELECT *, (((doctor_id + 17) * (hospital_id + 79) % 200 * 393342739) % 200)::INTEGER AS v,
  (((doctor_id + 7) * (hospital_id + 3) % 500 * 413158511) % 500)::INTEGER AS p,
  ((hospital_id * 67867967) % 700 + 300)::INTEGER AS cap FROM edges)"""


def _contract_round(r: int) -> str:
    at = "" if r == 1 else (f"LEFT JOIN m{r - 1} m USING (doctor_id) "
                            "WHERE m.doctor_rank IS NULL OR t.doctor_rank <= m.doctor_rank")
    return f"""
ap{r} AS (SELECT t.* FROM terms t {at}),
it{r} AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY hospital_id ORDER BY doctor_id) AS rn
                       FROM ap{r} WHERE v > 0 AND p < cap),
fw{r}(h, rn, cap, dp) AS MATERIALIZED (
  SELECT hospital_id, 0::BIGINT, any_value(cap), list_transform(range(any_value(cap)), lambda x: 0::INTEGER)
  FROM it{r} GROUP BY hospital_id
  UNION ALL
  SELECT f.h, i.rn, f.cap, list_transform(range(f.cap), lambda j: greatest(f.dp[j + 1],
    CASE WHEN j >= i.p THEN f.dp[j - i.p + 1] + i.v ELSE 0 END)::INTEGER)
  FROM fw{r} f JOIN it{r} i ON i.hospital_id = f.h AND i.rn = f.rn + 1),
bw{r}(h, rn, j, taken) AS (
  SELECT h, max(rn) + 1, arg_max(list_position(dp, list_max(dp)), rn)::BIGINT - 1, false FROM fw{r} GROUP BY h
  UNION ALL
  SELECT h, rn, CASE WHEN take THEN j - p ELSE j END, take FROM (
    SELECT b.h, i.rn, b.j, i.p, CASE WHEN b.j >= i.p THEN f.dp[b.j - i.p + 1] + i.v >= f.dp[b.j + 1]
                                     ELSE false END AS take
    FROM bw{r} b JOIN it{r} i ON i.hospital_id = b.h AND i.rn = b.rn - 1
    JOIN fw{r} f ON f.h = b.h AND f.rn = i.rn - 1) x),
m{r} AS MATERIALIZED (
  SELECT i.doctor_id, min(i.doctor_rank) AS doctor_rank, arg_min(i.hospital_id, i.doctor_rank) AS hospital_id,
         arg_min(i.hospital_rank, i.doctor_rank) AS hospital_rank, arg_min(i.v, i.doctor_rank) AS v,
         arg_min(i.p, i.doctor_rank) AS p
  FROM it{r} i JOIN bw{r} b ON b.h = i.hospital_id AND b.rn = i.rn AND b.taken GROUP BY i.doctor_id),
n{r} AS (SELECT count(*) AS n FROM m{r} a {f"FULL JOIN m{r - 1} b USING (doctor_id) WHERE a.hospital_id IS DISTINCT FROM b.hospital_id" if r > 1 else ""})"""


CONTRACT_ROUNDS = 4

_SEEN = " UNION ALL ".join(f"""
  SELECT {r} AS r, (SELECT n FROM n{r}) AS n, (SELECT coalesce(string_agg(doctor_id || ':' || hospital_id, ','
         ORDER BY doctor_id), '') FROM m{r}) AS g""" for r in range(1, CONTRACT_ROUNDS + 1))

# The first round without a change, or the last; and which matchings came before.
CONTRACT_END = f"""
seen AS ({_SEEN}),
past AS (SELECT a.r, a.n, max(b.r) AS j FROM seen a LEFT JOIN seen b ON b.r < a.r AND b.g = a.g GROUP BY a.r, a.n),
last AS (SELECT * FROM past WHERE n = 0 OR r = {CONTRACT_ROUNDS} ORDER BY r LIMIT 1)"""

KNAPSACK = """
kp AS (SELECT DISTINCT doctor_id AS d, hospital_id AS h FROM edges),
ki AS (SELECT h, d, ((d + 17) * (h + 79) % 200 * 393342739) % 200 AS v,
              ((d + 7) * (h + 3) % 500 * 413158511) % 500 AS p, (h * 67867967) % 700 + 300 AS cap FROM kp),
kf AS (SELECT *, row_number() OVER (PARTITION BY h ORDER BY d) AS rn FROM ki WHERE v > 0 AND p < cap),
k(h, rn, cap, dp) AS (
  SELECT h, 0::BIGINT, any_value(cap), list_transform(range(any_value(cap)), lambda x: 0::BIGINT)
  FROM kf GROUP BY h
  UNION ALL
  SELECT k.h, kf.rn, k.cap, list_transform(range(k.cap), lambda j:
    greatest(k.dp[j + 1], CASE WHEN j >= kf.p THEN k.dp[j - kf.p + 1] + kf.v ELSE 0 END))
  FROM k JOIN kf ON k.h = kf.h AND kf.rn = k.rn + 1),
kz AS (SELECT h, arg_max(dp, rn) AS dp FROM k GROUP BY h)"""


def _w(*parts: str, recursive: bool = False) -> str:
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",".join(p.strip("\n") for p in parts) + "\n"


SQL: dict[str, str] = {
    "market_edges": _w(MARKET) + f"SELECT {EDGE_SELECT} FROM edges",

    "match_hospital_optimal": _w(MARKET, I2, recursive=True) + f"SELECT {EDGE_SELECT} FROM i2",

    "match_hospital_optimal_contested":
        _w(CONTESTED, I2, recursive=True) + f"SELECT {EDGE_SELECT} FROM i2",

    "match_doctor_optimal": _w(CONTESTED, I1, recursive=True) + f"SELECT {EDGE_SELECT} FROM i1",

    "convergence_trace": _w(MARKET, I2, TRACE2, recursive=True) + "SELECT * FROM t2",

    "convergence_trace_doctor": _w(MARKET, I1, TRACE1, recursive=True) + "SELECT * FROM t1",

    "convergence_report": _w(MARKET, I2, TRACE2, I1, TRACE1, """
tr AS (SELECT 'hospital_optimal' AS run, * FROM t2 UNION ALL SELECT 'doctor_optimal', * FROM t1)""",
                             recursive=True) + """
SELECT run, max(iteration)::BIGINT AS rounds,
       min(CASE WHEN n_changes = 0 THEN iteration END)::BIGINT AS first_zero,
       sum(n_changes)::BIGINT AS total_changes
FROM tr GROUP BY run""",

    "convergence_running": _w(MARKET, I2, TRACE2, I1, TRACE1, """
tr AS (SELECT 'hospital_optimal' AS run, * FROM t2 UNION ALL SELECT 'doctor_optimal', * FROM t1)""",
                              recursive=True) + """
SELECT run, iteration, n_changes,
       sum(n_changes) OVER (PARTITION BY run ORDER BY iteration
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS cumulative_changes
FROM tr""",

    "blocking_pairs": _w(MARKET, STATE2, "mt AS (SELECT * FROM state)", _blocking("20"))
        + f"SELECT {EDGE_SELECT} FROM bp",

    "stability_check": _w(MARKET, I2, "mt AS (SELECT * FROM i2)", BLOCKING, STATE2,
                          _blocking("20").replace("mt", "state").replace("md ", "md2 ")
                          .replace("md.", "md2.").replace("md U", "md2 U").replace("mh", "mh2")
                          .replace("bp AS", "bp2 AS"), recursive=True)
        + "SELECT count(*)::BIGINT AS n_blocking, count(*) = 0 AS is_stable, "
          "'hospital_optimal' AS matching FROM bp UNION ALL "
          "SELECT count(*)::BIGINT, count(*) = 0, 'second_round' FROM bp2",

    "match_hospital_optimal_quotas":
        _w(_quota_market(MARKET), _with_q(I2, "a2"), recursive=True) + f"SELECT {EDGE_SELECT} FROM i2",

    "match_doctor_optimal_quotas":
        _w(_quota_market(CONTESTED), _with_q(I1, "a1"), recursive=True) + f"SELECT {EDGE_SELECT} FROM i1",

    "blocking_pairs_quotas": _w(MARKET, QUOTAS, STATE2, "mt AS (SELECT * FROM state)", _blocking(CAP))
        + f"SELECT {EDGE_SELECT} FROM bp",

    "matching_consistency_quotas": _w(MARKET, QUOTAS, STATE2) + _consistency("state", """
         SELECT count(*) FROM (SELECT hospital_id, count(*) AS c FROM state GROUP BY 1) f
         LEFT JOIN caps USING (hospital_id) WHERE c > coalesce(cap, 0)"""),

    "fill_report_quotas": _w(MARKET, QUOTAS, STATE2, """
f AS (SELECT s.s_suppkey, count(m.doctor_id) AS fill, coalesce(any_value(cap), 0) AS cap
      FROM supplier s LEFT JOIN state m ON m.hospital_id = s.s_suppkey
      LEFT JOIN caps c ON c.hospital_id = s.s_suppkey GROUP BY s.s_suppkey)""") + """
SELECT count(*)::BIGINT AS n_hospitals, sum(fill)::BIGINT AS filled, sum(cap)::BIGINT AS capacity,
       sum(CASE WHEN fill >= cap THEN 1 ELSE 0 END)::BIGINT AS n_full,
       sum(CASE WHEN fill = 0 THEN 1 ELSE 0 END)::BIGINT AS n_empty FROM f""",

    "rank_within_split": """
SELECT hospital_id::BIGINT AS hospital_id, l_orderkey::BIGINT AS order_id,
       row_number() OVER (PARTITION BY hospital_id ORDER BY price DESC, l_orderkey)::BIGINT AS position
FROM (SELECT l_suppkey AS hospital_id, l_orderkey, max(l_extendedprice) AS price
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)""",

    "matching_consistency": _w(MARKET, I2, """
broken AS (SELECT doctor_id, hospital_id FROM i2
           UNION ALL SELECT doctor_id, hospital_id + 1 FROM i2 WHERE doctor_id % 3 = 0)""", recursive=True)
        + _consistency("i2", _over_six("i2"), "hospital_optimal") + " UNION ALL "
        + _consistency("broken", _over_six("broken"), "broken"),

    "contiguous_ids": """
SELECT min(c_custkey)::BIGINT AS min_id, max(c_custkey)::BIGINT AS max_id,
       count(DISTINCT c_custkey)::BIGINT AS n_distinct,
       min(c_custkey) = 0 AND max(c_custkey) = count(DISTINCT c_custkey) - 1 AS contiguous,
       'doctor' AS side FROM customer
UNION ALL
SELECT min(s_suppkey)::BIGINT, max(s_suppkey)::BIGINT, count(DISTINCT s_suppkey)::BIGINT,
       min(s_suppkey) = 0 AND max(s_suppkey) = count(DISTINCT s_suppkey) - 1, 'hospital' FROM supplier""",

    "programs_by_applicant": _w(MARKET) + """
SELECT hospital_id::BIGINT AS hospital_id, doctor_id::BIGINT AS doctor_id,
       hospital_rank::BIGINT AS hospital_rank FROM edges""",

    "explode_preferences": """
SELECT l_orderkey::BIGINT AS order_id, l_suppkey::BIGINT AS hospital_id, min(pos)::BIGINT AS position
FROM (SELECT l_orderkey, l_suppkey,
             row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey) - 1 AS pos
      FROM lineitem) GROUP BY 1, 2""",

    "collapse_preferences": _w(MARKET) + """
SELECT doctor_id::BIGINT AS doctor_id, count(*)::BIGINT AS n_prefs,
       string_agg(hospital_id::VARCHAR, ' ' ORDER BY doctor_rank) AS prefs_text
FROM edges GROUP BY doctor_id""",

    "pref_text_roundtrip": _w(MARKET) + """
SELECT s_suppkey::BIGINT AS hospital_id, count(e.doctor_id)::BIGINT AS n_prefs,
       coalesce(string_agg(e.doctor_id::VARCHAR, ' ' ORDER BY e.hospital_rank), '') AS prefs_text
FROM supplier LEFT JOIN edges e ON e.hospital_id = s_suppkey GROUP BY s_suppkey""",

    "pref_text_rescued": _w(MARKET) + """
SELECT hospital_id, CASE WHEN reason IS NULL THEN t END AS prefs_text, CASE WHEN reason IS NOT NULL THEN t END AS text,
       reason, reason IS NOT NULL AS has_line
FROM (SELECT hospital_id, CASE WHEN hospital_id % 7 = 3 THEN 'x' || hospital_id || ' ' ELSE '' END || t
             || CASE WHEN hospital_id % 11 = 5 THEN ' 99999999999999999999' ELSE '' END AS t,
             CASE WHEN hospital_id % 7 = 3 THEN 'not an integer: x' || hospital_id
                  WHEN hospital_id % 11 = 5 THEN 'beyond 64 bits: 99999999999999999999' END AS reason
      FROM (SELECT s_suppkey::BIGINT AS hospital_id,
                   coalesce(string_agg(e.doctor_id::VARCHAR, ' ' ORDER BY e.hospital_rank), '') AS t
            FROM supplier LEFT JOIN edges e ON e.hospital_id = s_suppkey GROUP BY s_suppkey))""",

    "market_text_roundtrip": _w(MARKET) + """
SELECT doctor_id::BIGINT AS doctor_id, hospital_id::BIGINT AS hospital_id,
       (doctor_rank - 1)::BIGINT AS doctor_rank, (hospital_rank - 1)::BIGINT AS hospital_rank FROM edges""",

    "matching_text_output": _w(MARKET, I2, recursive=True) + """
SELECT c_custkey::BIGINT AS doctor_id, coalesce(m.hospital_id, -1)::BIGINT AS hospital_id
FROM customer LEFT JOIN i2 m ON m.doctor_id = c_custkey""",

    "next_choice": _w(MARKET, STATE, """
rej AS (SELECT doctor_id, hospital_id FROM ranked_prop WHERE pos > 6),
rem AS (SELECT * FROM edges ANTI JOIN rej USING (doctor_id, hospital_id))""") + """
SELECT doctor_id::BIGINT AS doctor_id, arg_min(hospital_id, doctor_rank)::BIGINT AS hospital_id,
       min(doctor_rank)::BIGINT AS doctor_rank FROM rem GROUP BY doctor_id""",

    "drop_first_choice": _w(MARKET, STATE2, """
docs AS (SELECT DISTINCT doctor_id FROM edges),
kept AS (SELECT e.* FROM edges e LEFT JOIN state s USING (doctor_id)
         WHERE NOT (s.doctor_id IS NULL AND e.doctor_rank = 1))""") + """
SELECT d.doctor_id::BIGINT AS doctor_id, count(k.hospital_id)::BIGINT AS n_prefs,
       coalesce(string_agg(k.hospital_id::VARCHAR, ' ' ORDER BY k.doctor_rank), '') AS prefs_text
FROM docs d LEFT JOIN kept k USING (doctor_id) GROUP BY d.doctor_id""",

    "choices_at_or_above": _w(MARKET, STATE2) + """
SELECT e.doctor_id::BIGINT AS doctor_id, e.hospital_id::BIGINT AS hospital_id,
       e.doctor_rank::BIGINT AS doctor_rank
FROM edges e LEFT JOIN state s USING (doctor_id)
WHERE s.doctor_rank IS NULL OR e.doctor_rank <= s.doctor_rank""",

    "choices_strictly_above": _w(MARKET, STATE2) + """
SELECT e.doctor_id::BIGINT AS doctor_id, e.hospital_id::BIGINT AS hospital_id,
       e.doctor_rank::BIGINT AS doctor_rank
FROM edges e LEFT JOIN state s USING (doctor_id)
WHERE s.doctor_rank IS NULL OR e.doctor_rank < s.doctor_rank""",

    "candidates_above_worst": _w(MARKET, STATE2, """
w AS (SELECT hospital_id, max(hospital_rank) AS worst FROM state GROUP BY 1)""") + """
SELECT e.hospital_id::BIGINT AS hospital_id, e.doctor_id::BIGINT AS doctor_id,
       e.hospital_rank::BIGINT AS hospital_rank
FROM edges e JOIN w USING (hospital_id) WHERE e.hospital_rank < w.worst""",

    "rank_lookup": _w(MARKET, STATE2) + """
SELECT doctor_id::BIGINT AS doctor_id, hospital_id::BIGINT AS hospital_id,
       (doctor_rank - 1)::BIGINT AS position FROM state""",

    "matching_with_unmatched": _w(MARKET, STATE2) + """
SELECT c_custkey::BIGINT AS doctor_id, coalesce(s.hospital_id, -1)::BIGINT AS hospital_id
FROM customer LEFT JOIN state s ON s.doctor_id = c_custkey""",

    "matched_only": _w(MARKET, STATE2) + """
SELECT doctor_id::BIGINT AS doctor_id, hospital_id::BIGINT AS hospital_id FROM state""",

    "active_proposers": _w(MARKET, STATE2) + """
SELECT DISTINCT doctor_id::BIGINT AS doctor_id FROM edges ANTI JOIN state USING (doctor_id)""",

    "changed_matches": _w(MARKET, STATE2, I2, recursive=True) + """
SELECT c_custkey::BIGINT AS doctor_id, s.hospital_id::BIGINT AS old_hospital_id,
       m.hospital_id::BIGINT AS new_hospital_id
FROM customer LEFT JOIN state s ON s.doctor_id = c_custkey LEFT JOIN i2 m ON m.doctor_id = c_custkey
WHERE s.hospital_id IS DISTINCT FROM m.hospital_id""",

    "one_sided_pairs": """
WITH l AS (SELECT o_custkey AS doctor_id, l_suppkey AS hospital_id, l_returnflag
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
d AS (SELECT DISTINCT doctor_id, hospital_id FROM l WHERE l_returnflag <> 'A'),
h AS (SELECT DISTINCT doctor_id, hospital_id FROM l WHERE l_returnflag <> 'R')
SELECT doctor_id::BIGINT AS doctor_id, hospital_id::BIGINT AS hospital_id, 'doctor' AS side
FROM d ANTI JOIN h USING (doctor_id, hospital_id)
UNION ALL
SELECT doctor_id::BIGINT, hospital_id::BIGINT, 'hospital' FROM h ANTI JOIN d USING (doctor_id, hospital_id)""",

    "mutual_edges": """
WITH l AS (SELECT o_custkey AS doctor_id, l_suppkey AS hospital_id, l_quantity, l_extendedprice, l_returnflag
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
d AS (SELECT doctor_id, hospital_id,
             row_number() OVER (PARTITION BY doctor_id ORDER BY sum(l_quantity) DESC, hospital_id) AS doctor_rank
      FROM l WHERE l_returnflag <> 'A' GROUP BY 1, 2),
h AS (SELECT doctor_id, hospital_id,
             row_number() OVER (PARTITION BY hospital_id ORDER BY max(l_extendedprice) DESC, doctor_id)
               AS hospital_rank
      FROM l WHERE l_returnflag <> 'R' GROUP BY 1, 2)
SELECT doctor_id::BIGINT AS doctor_id, hospital_id::BIGINT AS hospital_id,
       doctor_rank::BIGINT AS doctor_rank, hospital_rank::BIGINT AS hospital_rank
FROM d JOIN h USING (doctor_id, hospital_id)""",

    "hospital_rosters": _w(MARKET, I2, recursive=True) + """
SELECT s_suppkey::BIGINT AS hospital_id, count(m.doctor_id)::BIGINT AS n_matched,
       coalesce(string_agg(m.doctor_id::VARCHAR, ' ' ORDER BY m.hospital_rank), '') AS roster_text
FROM supplier LEFT JOIN i2 m ON m.hospital_id = s_suppkey GROUP BY s_suppkey""",

    "group_proposals": _w(MARKET, STATE) + """
SELECT hospital_id::BIGINT AS hospital_id, count(*)::BIGINT AS n_proposals,
       min(doctor_id)::BIGINT AS min_doctor_id, max(doctor_id)::BIGINT AS max_doctor_id
FROM prop GROUP BY hospital_id""",

    "fill_report": _w(MARKET, I2, """
f AS (SELECT s_suppkey, count(m.doctor_id) AS fill FROM supplier LEFT JOIN i2 m ON m.hospital_id = s_suppkey
      GROUP BY s_suppkey)""", recursive=True) + """
SELECT count(*)::BIGINT AS n_hospitals, sum(fill)::BIGINT AS filled, (count(*) * 6)::BIGINT AS capacity,
       sum(CASE WHEN fill >= 6 THEN 1 ELSE 0 END)::BIGINT AS n_full,
       sum(CASE WHEN fill = 0 THEN 1 ELSE 0 END)::BIGINT AS n_empty FROM f""",

    "worst_held_rank": _w(MARKET, STATE2) + """
SELECT hospital_id::BIGINT AS hospital_id, max(hospital_rank)::BIGINT AS worst_rank,
       count(*)::BIGINT AS n_held FROM state GROUP BY hospital_id""",

    "best_offer": _w(MARKET, """
offers AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hospital_id ORDER BY hospital_rank) AS pos
                          FROM edges) WHERE pos <= 6)""") + """
SELECT doctor_id::BIGINT AS doctor_id, arg_min(hospital_id, doctor_rank)::BIGINT AS hospital_id,
       min(doctor_rank)::BIGINT AS doctor_rank FROM offers GROUP BY doctor_id""",

    "top_n_per_group": _w(MARKET, STATE) + """
SELECT hospital_id::BIGINT AS hospital_id, doctor_id::BIGINT AS doctor_id,
       hospital_rank::BIGINT AS hospital_rank FROM state""",

    "rejected_applicants": _w(MARKET, STATE) + """
SELECT hospital_id::BIGINT AS hospital_id, doctor_id::BIGINT AS doctor_id,
       hospital_rank::BIGINT AS hospital_rank FROM ranked_prop WHERE pos > 6""",

    "union_options": _w(MARKET, STATE, """
bumped AS (SELECT doctor_id FROM ranked_prop WHERE pos > 6),
new_apps AS (SELECT e.hospital_id, e.doctor_id FROM edges e JOIN bumped USING (doctor_id)
             WHERE e.doctor_rank = 2)""") + """
SELECT DISTINCT hospital_id::BIGINT AS hospital_id, doctor_id::BIGINT AS doctor_id
FROM (SELECT hospital_id, doctor_id FROM new_apps UNION ALL SELECT hospital_id, doctor_id FROM state)""",

    "pair_intersection": _w(MARKET, STATE2, """
w AS (SELECT hospital_id, max(hospital_rank) AS worst FROM state GROUP BY 1),
dp AS (SELECT e.doctor_id, e.hospital_id FROM edges e LEFT JOIN state s USING (doctor_id)
       WHERE s.doctor_rank IS NULL OR e.doctor_rank < s.doctor_rank),
hp AS (SELECT e.doctor_id, e.hospital_id FROM edges e JOIN w USING (hospital_id)
       WHERE e.hospital_rank < w.worst)""") + """
SELECT doctor_id::BIGINT AS doctor_id, hospital_id::BIGINT AS hospital_id FROM dp
INTERSECT SELECT doctor_id, hospital_id FROM hp""",

    "better_not_held": _w(MARKET, STATE2, """
w AS (SELECT hospital_id, max(hospital_rank) AS worst FROM state GROUP BY 1),
cand AS (SELECT e.hospital_id, e.doctor_id FROM edges e JOIN w USING (hospital_id)
         WHERE e.hospital_rank < w.worst)""") + """
SELECT hospital_id::BIGINT AS hospital_id, doctor_id::BIGINT AS doctor_id
FROM cand ANTI JOIN state USING (hospital_id, doctor_id)""",

    "contract_terms": _w(MARKET) + """
SELECT doctor_id::BIGINT AS doctor_id, hospital_id::BIGINT AS hospital_id,
       (((doctor_id + 17) * (hospital_id + 79) % 200 * 393342739) % 200)::BIGINT AS utility,
       (((doctor_id + 7) * (hospital_id + 3) % 500 * 413158511) % 500)::BIGINT AS price,
       ((hospital_id * 67867967) % 700 + 300)::BIGINT AS budget FROM edges""",

    "knapsack_best_value": _w(MARKET, KNAPSACK, recursive=True) + """
SELECT h::BIGINT AS hospital_id, list_max(dp)::BIGINT AS utility,
       (list_position(dp, list_max(dp)) - 1)::BIGINT AS spend FROM kz""",

    "synthetic_market": _w(SYNTH) + f"SELECT {EDGE_SELECT} FROM edges",

    "match_contracts": _w(MARKET, TERMS, *[_contract_round(r) for r in range(1, CONTRACT_ROUNDS + 1)],
                          CONTRACT_END, recursive=True) + f"""
SELECT doctor_id::BIGINT AS doctor_id, hospital_id::BIGINT AS hospital_id, doctor_rank::BIGINT AS doctor_rank,
       hospital_rank::BIGINT AS hospital_rank, v::BIGINT AS utility, p::BIGINT AS price,
       last.r::BIGINT AS rounds, last.n = 0 AS converged,
       (SELECT min_by(j, r) FROM past WHERE n > 0 AND j IS NOT NULL)::BIGINT AS cycle_start,
       (SELECT min_by(r - j, r) FROM past WHERE n > 0 AND j IS NOT NULL)::BIGINT AS cycle_length
FROM ({" UNION ALL ".join(f"SELECT {r} AS r, * FROM m{r}" for r in range(1, CONTRACT_ROUNDS + 1))}) m
JOIN last USING (r)""",

    "synthetic_market_distinct": _w(DISTINCT_SYNTH) + f"SELECT {EDGE_SELECT} FROM edges",

    "match_synthetic": _w(SYNTH, I2, recursive=True) + f"SELECT {EDGE_SELECT} FROM i2",
}


# Plain doctor-proposing rounds (no acceleration): only rejected proposals are
# deleted.  Not registered (about 120 rounds at sf0.01); the tests compare it
# with the engine at sf0.001.
I1_PLAIN = """
p1(it, doctor_id, hospital_id, doctor_rank, hospital_rank, o, held, kept, removed) AS (
  SELECT 0, doctor_id, hospital_id, doctor_rank, hospital_rank, false, false, true, 1::HUGEINT
  FROM edges
  UNION ALL
  SELECT it + 1, doctor_id, hospital_id, doctor_rank, hospital_rank, o2, o2 AND rn <= 6,
         NOT (o2 AND rn > 6), sum(CASE WHEN o2 AND rn > 6 THEN 1 ELSE 0 END) OVER ()
  FROM (SELECT *, row_number() OVER (PARTITION BY hospital_id, o2 ORDER BY hospital_rank) AS rn
        FROM (SELECT it, doctor_id, hospital_id, doctor_rank, hospital_rank,
                     row_number() OVER (PARTITION BY doctor_id ORDER BY doctor_rank) = 1 AS o2
              FROM p1 WHERE removed > 0 AND kept) x) y),
ip AS (SELECT doctor_id, hospital_id, doctor_rank, hospital_rank FROM p1
       WHERE it = (SELECT max(it) FROM p1) AND o)"""

TRACE_PLAIN = (TRACE1.replace("a1", "p1").replace("m1", "mp").replace("its1", "itsp")
               .replace("prv1", "prvp").replace("ch1", "chp").replace("c1", "cp")
               .replace("t1 AS", "tp AS"))

PLAIN_SQL = {
    "match_doctor_optimal_plain": _w(MARKET, I1_PLAIN, recursive=True) + f"SELECT {EDGE_SELECT} FROM ip",
    "convergence_trace_plain": _w(MARKET, I1_PLAIN, TRACE_PLAIN, recursive=True) + "SELECT * FROM tp",
}

SQL["convergence_trace_doctor_plain"] = PLAIN_SQL["convergence_trace_plain"]
SQL["convergence_history"] = SQL["convergence_report"]
