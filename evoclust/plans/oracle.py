"""DuckDB/ANSI SQL twins of the registered queries (the correctness oracle).

Every statement reads the pre-registered views (``embeddings``, ``part``,
``customer``) and rebuilds the same computation declaratively: long-form
vectors ``lp(row_id, j, v)``, Lloyd steps unrolled as CTEs, seeded draws by
``md5`` exactly as :func:`evoclust.functions.vector.uniform` computes them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from evoclust.functions.vector import uniform_sql
from evoclust.plans.params import ITERS, K, MUT_RATE, OFFSET, P, SEED


@contextmanager
def _sizes(population: int, k: int) -> Iterator[None]:
    """Statements built inside are for this population and number of clusters."""
    global P, K
    held, (P, K) = (P, K), (population, k)
    try:
        yield
    finally:
        P, K = held


def _u(*tags, row_id="row_id") -> str:
    return uniform_sql(SEED, *tags, row_id=row_id)


def _us(*tags) -> str:
    """Scalar draw (driver side in Spark) as SQL."""
    key = "|".join(str(p) for p in (SEED, *tags))
    return f"(('0x' || substr(md5('{key}'), 1, 8))::BIGINT / 4294967296.0)"


PTS = """pts AS (SELECT vec_id AS row_id, CAST(embedding AS DOUBLE[]) AS x, label FROM embeddings),
lp AS (SELECT row_id, unnest(generate_series(0, len(x) - 1)) AS j, unnest(x) AS v FROM pts),
posn AS (SELECT row_id, row_number() OVER (ORDER BY row_id) - 1 AS pos FROM pts)"""


def _centres(chrom: int, name: str) -> str:
    """K rows with the smallest u(seed, 'init', chrom, row_id) -> (c, j, v)."""
    return f"""{name}_ids AS (
  SELECT (row_number() OVER (ORDER BY u, row_id) - 1) AS c, row_id
  FROM (SELECT row_id, {_u('init', chrom)} AS u FROM pts ORDER BY u, row_id LIMIT {K})),
{name} AS (SELECT i.c, l.j, l.v FROM {name}_ids i JOIN lp l USING (row_id))"""


def _assign(cen: str, name: str) -> str:
    """Nearest centre, ties to the lowest id -> (row_id, c, d2)."""
    return f"""{name}_d AS (
  SELECT p.row_id, c.c, sum((p.v - c.v) * (p.v - c.v)) AS d2
  FROM lp p JOIN {cen} c ON p.j = c.j GROUP BY p.row_id, c.c),
{name} AS (
  SELECT row_id, m.c AS c, m.d AS d2
  FROM (SELECT row_id, min({{'d': d2, 'c': c}}) AS m FROM {name}_d GROUP BY row_id))"""


def _update(asg: str, old: str, name: str) -> str:
    """A1/A2 + Q1: member means; an empty cluster keeps its old centre."""
    return f"""{name} AS (
  SELECT a.c, p.j, avg(p.v) AS v FROM {asg} a JOIN lp p USING (row_id) GROUP BY a.c, p.j
  UNION ALL
  SELECT c, j, v FROM {old} WHERE c NOT IN (SELECT DISTINCT c FROM {asg}))"""


def _lloyd(iters: int, start: str = "cen0") -> str:
    """Unrolled Lloyd steps: a1 uses cen0, cen1 = means of a1, ..."""
    parts = []
    for t in range(1, iters + 1):
        parts.append(_assign(f"cen{t - 1}" if t > 1 else start, f"a{t}"))
        parts.append(_update(f"a{t}", f"cen{t - 1}" if t > 1 else start, f"cen{t}"))
    return ",\n".join(parts)


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


#: ``events`` in the place of ``embeddings``: many more points, two dimensions, five labels.
PTS_EVENTS = """pts AS (SELECT event_id AS row_id, [value, extract(minute FROM ts) / 10.0] AS x,
  CAST(list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type) - 1 AS INT) AS label FROM events),
lp AS (SELECT row_id, unnest(generate_series(0, len(x) - 1)) AS j, unnest(x) AS v FROM pts),
posn AS (SELECT row_id, row_number() OVER (ORDER BY row_id) - 1 AS pos FROM pts)"""
R6 = "round({}, 6)"


def _r(x: str) -> str:
    return f"round({x}, 6)"


# ------------------------------------------------------------------ pair indices

def _pair_counts(asg: str) -> str:
    return f"""ct AS (SELECT label, c, count(*)::DOUBLE AS n FROM {asg} a JOIN pts USING (row_id) GROUP BY label, c),
pc AS (
  SELECT (SELECT sum(n * (n - 1) / 2) FROM ct) AS T,
         (SELECT sum(s * (s - 1) / 2) FROM (SELECT sum(n) AS s FROM ct GROUP BY label)) AS A,
         (SELECT sum(s * (s - 1) / 2) FROM (SELECT sum(n) AS s FROM ct GROUP BY c)) AS B,
         (SELECT sum(n) * (sum(n) - 1) / 2 FROM ct) AS NP)"""


ARI = "CASE WHEN (A + B) / 2 - A * B / NP = 0 THEN 1.0 ELSE (T - A * B / NP) / ((A + B) / 2 - A * B / NP) END"
FM = "CASE WHEN T = 0 THEN 0.0 ELSE T / sqrt(A * B) END"
PJ = "CASE WHEN A + B - T = 0 THEN 1.0 ELSE T / (A + B - T) END"


# ------------------------------------------------------------------ silhouettes

def _silhouette(asg: str, squared: bool, name: str = "sil") -> str:
    """Silhouette per chromosome from all pairs: ``asg(chrom, row_id, c)``."""
    dd = "list_distance(a.x, b.x) * list_distance(a.x, b.x)" if squared else "list_distance(a.x, b.x)"
    return f"""{name}_pair AS (SELECT a.row_id AS i, b.row_id AS k, {dd} AS dd FROM pts a, pts b),
{name}_per AS (
  SELECT ga.chrom, p.i, gb.c AS cb, sum(p.dd) AS s, count(*) AS m
  FROM {name}_pair p JOIN {asg} ga ON ga.row_id = p.i JOIN {asg} gb ON gb.row_id = p.k AND gb.chrom = ga.chrom
  GROUP BY ga.chrom, p.i, gb.c),
{name}_pt AS (
  SELECT o.chrom, o.row_id,
         max(CASE WHEN q.cb = o.c THEN q.s END) AS s_own,
         max(CASE WHEN q.cb = o.c THEN q.m END) AS n_own,
         min(CASE WHEN q.cb <> o.c THEN q.s / q.m END) AS b
  FROM {asg} o JOIN {name}_per q ON q.chrom = o.chrom AND q.i = o.row_id GROUP BY o.chrom, o.row_id),
{name}_pv AS (
  SELECT chrom, CASE WHEN n_own <= 1 OR b IS NULL THEN 0.0
              WHEN greatest(b, s_own / (n_own - 1)) = 0 THEN 0.0
              ELSE (b - s_own / (n_own - 1)) / greatest(b, s_own / (n_own - 1)) END AS s
  FROM {name}_pt),
{name} AS (
  SELECT c.chrom, CASE WHEN count(DISTINCT c.c) < 2 THEN -1.0 ELSE (SELECT avg(s) FROM {name}_pv v WHERE v.chrom = c.chrom) END AS fitness
  FROM {asg} c GROUP BY c.chrom)"""


def _davies_bouldin(asg: str) -> str:
    return f"""dbc AS (SELECT a.c, p.j, avg(p.v) AS v FROM {asg} a JOIN lp p USING (row_id) GROUP BY a.c, p.j),
dbd AS (SELECT a.row_id, a.c, sqrt(sum((p.v - c.v) * (p.v - c.v))) AS dd
        FROM {asg} a JOIN lp p USING (row_id) JOIN dbc c ON c.c = a.c AND c.j = p.j GROUP BY a.row_id, a.c),
dbs AS (SELECT c, avg(dd) AS s FROM dbd GROUP BY c),
dbp AS (SELECT c1.c AS ci, c2.c AS cj, sqrt(sum((c1.v - c2.v) * (c1.v - c2.v))) AS dij
        FROM dbc c1 JOIN dbc c2 ON c1.j = c2.j AND c1.c <> c2.c GROUP BY c1.c, c2.c),
dbr AS (SELECT p.ci, max((s1.s + s2.s) / p.dij) AS r FROM dbp p JOIN dbs s1 ON s1.c = p.ci JOIN dbs s2 ON s2.c = p.cj GROUP BY p.ci),
db AS (SELECT avg(r) AS davies_bouldin FROM dbr)"""


def _sse_to_means(asg: str, name: str) -> str:
    """SSE of labels ``asg(chrom, row_id, c)`` against their own means."""
    return f"""{name}_m AS (SELECT a.chrom, a.c, p.j, avg(p.v) AS v FROM {asg} a JOIN lp p USING (row_id) GROUP BY a.chrom, a.c, p.j),
{name} AS (SELECT a.chrom, sum((p.v - m.v) * (p.v - m.v)) AS sse
           FROM {asg} a JOIN lp p USING (row_id) JOIN {name}_m m ON m.chrom = a.chrom AND m.c = a.c AND m.j = p.j
           GROUP BY a.chrom)"""


# ------------------------------------------------------------------ population

def _population() -> str:
    """G1: P chromosomes of k sampled centres; ``pop(chrom, row_id, c)``, ``pcen(chrom, c, j, v)``."""
    parts = []
    for ch in range(P):
        parts.append(_centres(ch, f"pc{ch}"))
        parts.append(_assign(f"pc{ch}", f"pa{ch}"))
    unions_a = " UNION ALL ".join(f"SELECT {ch} AS chrom, row_id, c, d2 FROM pa{ch}" for ch in range(P))
    unions_c = " UNION ALL ".join(f"SELECT {ch} AS chrom, c, j, v FROM pc{ch}" for ch in range(P))
    parts.append(f"pop AS ({unions_a})")
    parts.append(f"pcen AS ({unions_c})")
    return ",\n".join(parts)


def _select_slots(fit: str, gen: int = 1) -> str:
    """Ranks by fitness; keep int(P*0.8); fill from the top min(5, P)."""
    keep = int(P * 0.8)
    top = min(5, P)
    fills = " UNION ALL ".join(
        f"SELECT {i} AS k, (SELECT chrom FROM rk WHERE r = LEAST(CAST(floor({_us('fill', gen, i)} * {top}) AS BIGINT), {top - 1})) AS chrom"
        for i in range(keep, P)
    )
    src = f"SELECT r AS k, chrom FROM rk WHERE r < {keep}" + (f" UNION ALL {fills}" if fills else "")
    return f"""rk AS (SELECT chrom, fitness, row_number() OVER (ORDER BY fitness DESC, chrom) - 1 AS r FROM {fit}),
src AS ({src}),
sel AS (SELECT row_number() OVER (ORDER BY f.fitness DESC, s.k) - 1 AS slot, s.chrom, f.fitness
        FROM src s JOIN {fit} f USING (chrom))"""


def _cut(i: int = 0, gen: int = 1) -> str:
    return f"(1 + LEAST(CAST(floor({_us('cut', gen, i)} * ((SELECT count(*) FROM pts) - 2)) AS BIGINT), (SELECT count(*) FROM pts) - 3))"


def _children(a: int, b: int) -> str:
    """Aligned children of slots a, b at the first cut of generation 1."""
    return f"""cut AS (SELECT {_cut(0)} AS cut),
kids AS (
  SELECT pa.row_id,
         CASE WHEN n.pos < (SELECT cut FROM cut) THEN pa.c ELSE pb.c END AS child1,
         CASE WHEN n.pos < (SELECT cut FROM cut) THEN pb.c ELSE pa.c END AS child2
  FROM pop pa JOIN pop pb ON pb.row_id = pa.row_id AND pa.chrom = {a} AND pb.chrom = {b}
  JOIN posn n ON n.row_id = pa.row_id)"""


# tables of one generation; a later one gets a suffix of its own
_GENERATION = ("rk src sel slotlab slotcen ranks duo cut kid ksil ksil_pair ksil_per ksil_pt ksil_pv allfit comp win holdsrc "
               "held hf kidmeans hc crossed crossedfit crossedcen grid sizes rooms less more used cells draws msil msil_pair msil_per msil_pt msil_pv "
               "cand_d cand csil csil_pair csil_per csil_pt csil_pv acc fin fincen finfit best bl fsse fsse_m ct pc").split()


def _cross_step(first: int, second: int, cut: int, gen: int, parity: bool = False) -> str:
    """G7 of the pair drawn at these places: children, family competition, the slots after it
    (``crossed``, ``crossedfit``, ``crossedcen``) from ``slotlab``, ``slotcen`` and ``sel``.
    ``parity``: the second child is rotated (Q7), the children's centres are drawn (Q6)."""
    second_child = f"""SELECT 101, t.row_id, CASE WHEN t.pos < (SELECT count(*) FROM pts) - (SELECT cut FROM cut) THEN la.c ELSE lb.c END
  FROM posn t JOIN posn n ON n.pos = (t.pos + (SELECT cut FROM cut)) % (SELECT count(*) FROM pts)
  JOIN slotlab la ON la.row_id = n.row_id JOIN slotlab lb ON lb.row_id = n.row_id
  WHERE la.slot = (SELECT a FROM duo) AND lb.slot = (SELECT b FROM duo)""" if parity else """SELECT 101, la.row_id, CASE WHEN n.pos < (SELECT cut FROM cut) THEN lb.c ELSE la.c END
  FROM slotlab la JOIN slotlab lb ON lb.row_id = la.row_id JOIN posn n ON n.row_id = la.row_id
  WHERE la.slot = (SELECT a FROM duo) AND lb.slot = (SELECT b FROM duo)"""
    drawn = " UNION ALL ".join(
        f"""SELECT {100 + i} AS src, o.c, l.j, l.v FROM (SELECT row_number() OVER (ORDER BY u, row_id) - 1 AS c, row_id
   FROM (SELECT row_id, {_u(f"child{gen}.{cut}", i)} AS u FROM pts ORDER BY u, row_id LIMIT {K})) o JOIN lp l USING (row_id)""" for i in (0, 1))
    kid_centres = drawn if parity else """SELECT k.chrom AS src, k.c, p.j, avg(p.v) AS v FROM kid k JOIN lp p USING (row_id) GROUP BY k.chrom, k.c, p.j
  UNION ALL
  SELECT kk.chrom, sc.c, sc.j, sc.v FROM (SELECT DISTINCT chrom FROM kid) kk, slotcen sc
  WHERE sc.slot = (SELECT a FROM duo) AND NOT EXISTS (SELECT 1 FROM kid k2 WHERE k2.chrom = kk.chrom AND k2.c = sc.c)"""
    return f"""duo AS (SELECT (SELECT r FROM ranks WHERE ord = {first}) AS a, (SELECT r FROM ranks WHERE ord = {second}) AS b),
cut AS (SELECT {_cut(cut, gen)} AS cut),
kid AS (
  SELECT 100 AS chrom, la.row_id, CASE WHEN n.pos < (SELECT cut FROM cut) THEN la.c ELSE lb.c END AS c
  FROM slotlab la JOIN slotlab lb ON lb.row_id = la.row_id JOIN posn n ON n.row_id = la.row_id
  WHERE la.slot = (SELECT a FROM duo) AND lb.slot = (SELECT b FROM duo)
  UNION ALL
  {second_child}),
{_silhouette("kid", True, "ksil")},
allfit AS (SELECT slot AS src, fitness FROM sel UNION ALL SELECT chrom, fitness FROM ksil),
comp AS (
  SELECT 0 AS idx, (SELECT a FROM duo) AS src UNION ALL SELECT 1, (SELECT b FROM duo)
  UNION ALL SELECT 2, 100 UNION ALL SELECT 3, 101),
win AS (SELECT c.src, row_number() OVER (ORDER BY f.fitness DESC, c.idx) - 1 AS place
        FROM comp c JOIN allfit f USING (src)),
holdsrc AS (
  SELECT s.slot, CASE WHEN s.slot = (SELECT a FROM duo) THEN (SELECT src FROM win WHERE place = 0)
                      WHEN s.slot = (SELECT b FROM duo) THEN (SELECT src FROM win WHERE place = 1)
                      ELSE s.slot END AS src
  FROM sel s),
crossed AS (SELECT h.slot AS chrom, l.row_id, l.c FROM holdsrc h JOIN
         (SELECT slot AS src, row_id, c FROM slotlab UNION ALL SELECT chrom, row_id, c FROM kid) l ON l.src = h.src),
crossedfit AS (SELECT h.slot AS chrom, f.fitness FROM holdsrc h JOIN allfit f ON f.src = h.src),
kidmeans AS ({kid_centres}),
crossedcen AS (SELECT h.slot AS chrom, c.c, c.j, c.v FROM holdsrc h JOIN
       (SELECT slot AS src, c, j, v FROM slotcen UNION ALL SELECT src, c, j, v FROM kidmeans) c ON c.src = h.src)"""


def _chain(pairs: list[tuple[int, int]], gen: int) -> str:
    """:func:`_cross_step` of pair after pair, each on the slots that the one before left."""
    parts = ["slotlab_{0}s0 AS (SELECT * FROM slotlab), slotcen_{0}s0 AS (SELECT * FROM slotcen), sel_{0}s0 AS (SELECT slot, fitness FROM sel)".format(gen)]
    for i, (a, b) in enumerate(pairs):
        if i:
            before = f"{gen}s{i - 1}"
            parts.append(f"slotlab_{gen}s{i} AS (SELECT chrom AS slot, row_id, c FROM crossed_{before}), "
                         f"slotcen_{gen}s{i} AS (SELECT chrom AS slot, c, j, v FROM crossedcen_{before}), "
                         f"sel_{gen}s{i} AS (SELECT chrom AS slot, fitness FROM crossedfit_{before})")
        parts.append(_suffixed(_cross_step(a, b, i, gen), f"{gen}s{i}").replace(f"ranks_{gen}s{i}", "ranks"))
    last = f"{gen}s{len(pairs) - 1}"
    parts.append(f"crossed AS (SELECT * FROM crossed_{last}), crossedfit AS (SELECT * FROM crossedfit_{last}), crossedcen AS (SELECT * FROM crossedcen_{last})")
    return ",\n".join(parts)


def _one_generation(gen: int = 1, kmo: str = "better", mutation: float = 0.0, parity: bool = False) -> str:
    """G11, one generation: selection, the disjoint pairs crossed at their cuts,
    family competition, with a rate the mutation, k-means step (guarded or not).
    The first starts from ``pop``, ``pcen`` and ``silo``, a later one from the one before."""
    P1 = P - 1
    fit0, pop0, cen0 = ("silo", "pop", "pcen") if gen == 1 else (f"{t}_{gen - 1}" for t in ("finfit", "fin", "fincen"))
    take = "c.fitness > h.fitness" if kmo == "better" else "TRUE"
    m = int(0.8 * P) // 2
    cross = _cross_step(0, 1, 0, gen, parity) if m == 1 else _chain([(2 * i, 2 * i + 1) for i in range(m)], gen)
    text = f"""{_select_slots(fit0, gen)},
slotlab AS (SELECT s.slot, p.row_id, p.c FROM sel s JOIN {pop0} p ON p.chrom = s.chrom),
slotcen AS (SELECT s.slot, c.c, c.j, c.v FROM sel s JOIN {cen0} c ON c.chrom = s.chrom),
ranks AS (SELECT r, row_number() OVER (ORDER BY u, r) - 1 AS ord FROM (
  SELECT r, (('0x' || substr(md5('{SEED}|rank|{gen}|' || CAST(r AS VARCHAR)), 1, 8))::BIGINT / 4294967296.0) AS u
  FROM range(0, {P1}) t(r))),
{cross},
{_mutation(gen, mutation) if mutation else "held AS (SELECT * FROM crossed), hf AS (SELECT * FROM crossedfit), hc AS (SELECT * FROM crossedcen)"},
cand_d AS (SELECT m.chrom, p.row_id, m.c, sum((p.v - m.v) * (p.v - m.v)) AS d2 FROM lp p JOIN hc m ON m.j = p.j
           GROUP BY m.chrom, p.row_id, m.c),
cand AS (SELECT chrom, row_id, m.c AS c FROM (SELECT chrom, row_id, min({{'d': d2, 'c': c}}) AS m FROM cand_d GROUP BY chrom, row_id)),
{_silhouette("cand", True, "csil")},
acc AS (SELECT h.chrom, {take} AS take,
               CASE WHEN {take} THEN c.fitness ELSE h.fitness END AS fit
        FROM hf h JOIN csil c USING (chrom)),
fin AS (SELECT h.chrom, h.row_id, CASE WHEN a.take THEN c.c ELSE h.c END AS c
        FROM held h JOIN cand c USING (chrom, row_id) JOIN acc a USING (chrom)),
finfit AS (SELECT chrom, fit AS fitness FROM acc),
fincen AS (
  SELECT f.chrom, f.c, p.j, avg(p.v) AS v FROM fin f JOIN lp p USING (row_id) GROUP BY f.chrom, f.c, p.j
  UNION ALL
  SELECT chrom, c, j, v FROM hc WHERE NOT EXISTS (SELECT 1 FROM fin f WHERE f.chrom = hc.chrom AND f.c = hc.c)),
best AS (SELECT chrom, fit FROM acc ORDER BY fit DESC, chrom LIMIT 1),
bl AS (SELECT row_id, c FROM fin WHERE chrom = (SELECT chrom FROM best)),
{_sse_to_means("fin", "fsse")},
{_pair_counts("bl")}"""
    return _suffixed(text, gen)


def _alias(labels: str) -> str:
    """Alias cells (chrom, c, prob, alias) by the sizes of each chromosome's clusters.

    Cells below the average (``less``) draw on those above (``more``) in order of
    their ids; running totals say which one, and where one is used up."""
    return f"""grid AS (SELECT ch.chrom, r.c FROM (SELECT DISTINCT chrom FROM {labels}) ch, range(0, {K}) r(c)),
sizes AS (SELECT g.chrom, g.c, count(p.row_id) AS n FROM grid g LEFT JOIN {labels} p ON p.chrom = g.chrom AND p.c = g.c GROUP BY g.chrom, g.c),
rooms AS (SELECT chrom, c, n, sum(n) OVER (PARTITION BY chrom) AS total, n * {K} - sum(n) OVER (PARTITION BY chrom) AS room FROM sizes),
less AS (SELECT *, sum(-room) OVER (PARTITION BY chrom ORDER BY c) AS upto FROM rooms WHERE room < 0),
more AS (SELECT *, sum(room) OVER (PARTITION BY chrom ORDER BY c) AS upto, lead(c) OVER (PARTITION BY chrom ORDER BY c) AS nextc FROM rooms WHERE room > 0),
used AS (SELECT m.*, (SELECT min(l.upto) FROM less l WHERE l.chrom = m.chrom AND l.upto >= m.upto) AS over_ FROM more m),
cells AS (
  SELECT l.chrom, l.c, (l.n * {K})::DOUBLE / l.total::DOUBLE AS prob,
         (SELECT min(m.c) FROM more m WHERE m.chrom = l.chrom AND m.upto > l.upto + l.room) AS alias FROM less l
  UNION ALL
  SELECT chrom, c, CASE WHEN nextc IS NULL OR over_ IS NULL THEN 1.0 ELSE 1 - (over_ - upto)::DOUBLE / total::DOUBLE END, coalesce(nextc, c) FROM used
  UNION ALL
  SELECT chrom, c, 1.0, c FROM rooms WHERE room = 0)"""


def _drawn(rate: float) -> str:
    """The label of a row of ``draws``: kept, or the cell of the draw, or that cell's alias."""
    return f"""SELECT d.chrom, d.row_id, CASE WHEN d.um >= {rate} THEN d.c WHEN d.ud * {K} - x.c < x.prob THEN x.c ELSE x.alias END AS c
            FROM draws d JOIN cells x ON x.chrom = d.chrom AND x.c = floor(d.ud * {K})"""


def _mutation(gen: int, rate: float) -> str:
    """G8 inside a generation: labels redrawn by cluster size, centres and fitness from the new labels."""
    um = _u("mut", gen, "' || p.chrom || '", row_id="p.row_id")
    ud = _u("draw", gen, "' || p.chrom || '", row_id="p.row_id")
    return f"""{_alias("crossed")},
draws AS (SELECT p.chrom, p.row_id, p.c, {um} AS um, {ud} AS ud FROM crossed p),
held AS ({_drawn(rate)}),
{_silhouette("held", True, "msil")},
hf AS (SELECT chrom, fitness FROM msil),
hc AS (SELECT h.chrom, h.c, p.j, avg(p.v) AS v FROM held h JOIN lp p USING (row_id) GROUP BY h.chrom, h.c, p.j
       UNION ALL SELECT chrom, c, j, v FROM crossedcen x WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.chrom = x.chrom AND h.c = x.c))"""


def _suffixed(text: str, suffix) -> str:
    # not inside the keys of draws, where words stand between bars
    return re.sub(r"(?<![|\w])(" + "|".join(_GENERATION) + r")(?![|\w])", rf"\1_{suffix}", text)


def _ring() -> str:
    """G6 parity: selection, then neighbours on the ring of drawn ranks crossed one pair after the other."""
    m = int(0.8 * P)
    start = _one_generation(1).split("slotlab_1s0 AS (" if m > 3 else "duo_1 AS (")[0].rstrip().rstrip(",")
    chain = _suffixed(_chain([(i, (i + 1) % m) for i in range(m)], 1), 1)
    return _with(PTS, _population(), _silhouette("pop", True, "silo"), start, chain) + (
        "SELECT chrom::BIGINT AS chrom, round(fitness, 6) AS fitness FROM crossedfit_1")


def _generations(n: int, **options) -> str:
    """Statement of a fit's history over ``n`` generations."""
    first = _with(PTS, _population(), _silhouette("pop", True, "silo"), *[_one_generation(g, **options) for g in range(1, n + 1)])
    ari = lambda g: f"(SELECT {ARI} FROM pc_{g})"
    return first + " UNION ALL ".join(
        f"SELECT {g}::BIGINT AS gen, round((SELECT fit FROM best_{g}), 6) AS fitness, "
        f"round((SELECT sse FROM fsse_{g} WHERE chrom = (SELECT chrom FROM best_{g})), 6) AS sse, round({ari(g)}, 6) AS ari"
        for g in range(1, n + 1))


# ------------------------------------------------------------------ statements

def statements() -> dict[str, str]:
    base = [PTS]
    c0 = _centres(0, "cen0")
    a1 = _assign("cen0", "a1")
    asg1 = "asg1 AS (SELECT 0 AS chrom, row_id, c FROM a1)"
    q: dict[str, str] = {}

    q["s_points_from_columns"] = (
        "SELECT p_partkey AS row_id, row_number() OVER (ORDER BY p_partkey) - 1 AS pos, "
        "CAST(p_size AS DOUBLE) AS x0, p_retailprice AS x1 FROM part"
    )
    q["s_parse_vector_text"] = (
        "SELECT c_custkey AS row_id, round(c_acctbal, 6) AS x0, CAST(c_nationkey AS DOUBLE) AS x1 FROM customer"
    )
    q["p_recode_label"] = (
        "SELECT CAST(CASE WHEN label = 9 THEN 8 ELSE label END AS BIGINT) AS label, count(*) AS n "
        "FROM embeddings GROUP BY 1"
    )
    q["p_nominal_code"] = (
        "SELECT c_mktsegment AS segment, (dense_rank() OVER (ORDER BY c_mktsegment) - 1)::BIGINT AS code, n "
        "FROM (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1)"
    )
    q["p_drop_feature"] = (
        "SELECT p_partkey AS row_id, 1::BIGINT AS n_features, p_retailprice AS x0 FROM part"
    )
    q["r_sample_centers"] = _with(*base, *[_centres(ch, f"s{ch}") for ch in range(3)]) + " UNION ALL ".join(
        f"SELECT {ch}::BIGINT AS chrom, c::BIGINT AS c, row_id FROM s{ch}_ids" for ch in range(3)
    )
    q["j1_assign"] = _with(*base, c0, a1) + f"SELECT row_id, c::BIGINT AS cluster, {_r('d2')} AS d2 FROM a1"
    q["j4_own_center_distance"] = _with(*base, c0) + (
        f"SELECT p.row_id, {_r('sum((p.v - c.v) * (p.v - c.v))')} AS d2 "
        "FROM lp p JOIN pts t USING (row_id) JOIN cen0 c ON c.c = t.label AND c.j = p.j GROUP BY p.row_id"
    )
    q["k_one_step_centers"] = _with(*base, c0, _lloyd(1)) + f"SELECT c::BIGINT AS c, j::BIGINT AS j, {_r('v')} AS v FROM cen1"
    q["k_fit_3_iterations"] = _with(*base, c0, _lloyd(ITERS), _assign(f"cen{ITERS}", "fin")) + (
        f"SELECT c::BIGINT AS cluster, count(*) AS n, {_r('sum(d2)')} AS sse FROM fin GROUP BY c"
    )
    q["k_predict"] = _with(*base, c0, _lloyd(ITERS), _assign(f"cen{ITERS}", "fin")) + (
        "SELECT row_id, c::BIGINT AS cluster FROM fin"
    )
    q["k_sse_history"] = _with(*base, c0, _lloyd(ITERS)) + " UNION ALL ".join(
        f"SELECT {t}::BIGINT AS iter, {_r('sum(d2)')} AS sse FROM a{t}" for t in range(1, ITERS + 1)
    )
    q["k_center_history"] = _with(*base, c0, _lloyd(ITERS)) + " UNION ALL ".join(
        f"SELECT {t}::BIGINT AS iter, c::BIGINT AS c, j::BIGINT AS j, {_r('v')} AS v FROM cen{t}" for t in range(0, ITERS + 1)
    )
    q["a11_center_shift"] = _with(*base, c0, _lloyd(ITERS)) + " UNION ALL ".join(
        f"SELECT {t}::BIGINT AS iter, {_r('sum((o.v - n.v) * (o.v - n.v))')} AS shift "
        f"FROM cen{t - 1} o JOIN cen{t} n ON n.c = o.c AND n.j = o.j" for t in range(1, ITERS + 1)
    )
    far = f"""far0 AS (SELECT c, j, CASE WHEN c = {K - 1} THEN v + 100.0 ELSE v END AS v FROM cen0)"""
    q["k_empty_cluster_keeps_center"] = _with(*base, c0, far, _lloyd(2, start="far0")) + (
        f"SELECT c::BIGINT AS c, j::BIGINT AS j, {_r('v')} AS v FROM cen2"
    )
    q["a4_label_centers"] = _with(*base) + (
        f"SELECT t.label::BIGINT AS label, p.j::BIGINT AS j, {_r('avg(p.v)')} AS v "
        "FROM lp p JOIN pts t USING (row_id) GROUP BY t.label, p.j"
    )
    q["a7_contingency"] = _with(*base, c0, a1) + (
        "SELECT t.label::BIGINT AS label, a.c::BIGINT AS cluster, count(*) AS n FROM a1 a JOIN pts t USING (row_id) GROUP BY 1, 2"
    )
    q["e1_purity"] = _with(*base, c0, a1) + (
        f"SELECT {_r('sum(best) / sum(size)')} AS purity FROM (SELECT a.c, max(n) AS best, sum(n) AS size FROM "
        "(SELECT a.c, t.label, count(*) AS n FROM a1 a JOIN pts t USING (row_id) GROUP BY 1, 2) a GROUP BY a.c)"
    )
    q["e2_ari"] = _with(*base, c0, a1, _pair_counts("a1")) + f"SELECT {_r(ARI)} AS ari FROM pc"
    q["e3_label_agreement"] = _with(*base, c0, a1) + (
        f"SELECT {_r('avg(CASE WHEN t.label = a.c THEN 1.0 ELSE 0.0 END)')} AS label_agreement FROM a1 a JOIN pts t USING (row_id)"
    )
    q["e3_pair_jaccard"] = _with(*base, c0, a1, _pair_counts("a1")) + f"SELECT {_r(PJ)} AS pair_jaccard FROM pc"
    q["e4_fowlkes_mallows"] = _with(*base, c0, a1, _pair_counts("a1")) + f"SELECT {_r(FM)} AS fowlkes_mallows FROM pc"
    q["e5_silhouette_exact"] = _with(*base, c0, a1, asg1, _silhouette("asg1", False)) + (
        f"SELECT {_r('fitness')} AS silhouette_exact FROM sil"
    )
    q["e5_silhouette_pruned"] = """WITH p AS (
  SELECT event_id AS id, value AS a, extract(minute FROM ts) / 10.0 AS b, least(CAST(floor(value / 10) AS INT), 12) AS c FROM events),
m AS (SELECT p.id, p.c, q.c AS o, sum(sqrt((p.a - q.a) * (p.a - q.a) + (p.b - q.b) * (p.b - q.b))) AS s, count(*) AS n
      FROM p, p AS q GROUP BY p.id, p.c, q.c),
v AS (SELECT id, max(CASE WHEN o = c THEN n END) AS own, max(CASE WHEN o = c AND n > 1 THEN s / (n - 1) END) AS a,
             min(CASE WHEN o <> c THEN s / n END) AS b FROM m GROUP BY id)
SELECT round(avg(CASE WHEN own = 1 OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette_exact FROM v"""
    q["e6_silhouette_squared"] = _with(*base, c0, a1, asg1, _silhouette("asg1", True)) + (
        f"SELECT {_r('fitness')} AS silhouette_squared FROM sil"
    )
    q["e7_davies_bouldin"] = _with(*base, c0, a1, _davies_bouldin("a1")) + (
        f"SELECT {_r('davies_bouldin')} AS davies_bouldin FROM db"
    )
    q["e8_report"] = _with(
        *base, c0, a1, asg1, _pair_counts("a1"), _silhouette("asg1", True), _davies_bouldin("a1"),
        _sse_to_means("asg1", "sse1"),
    ) + (
        f"SELECT 'ari' AS metric, 'external' AS kind, {_r(ARI)} AS value FROM pc UNION ALL "
        f"SELECT 'label_agreement', 'external', {_r('avg(CASE WHEN t.label = a.c THEN 1.0 ELSE 0.0 END)')} FROM a1 a JOIN pts t USING (row_id) UNION ALL "
        f"SELECT 'fowlkes_mallows', 'external', {_r(FM)} FROM pc UNION ALL "
        f"SELECT 'pair_jaccard', 'external', {_r(PJ)} FROM pc UNION ALL "
        f"SELECT 'silhouette_squared', 'internal', {_r('fitness')} FROM sil UNION ALL "
        f"SELECT 'davies_bouldin', 'internal', {_r('davies_bouldin')} FROM db UNION ALL "
        f"SELECT 'sse', 'internal', {_r('sse')} FROM sse1"
    )

    pop = _population()
    q["g1_population_init"] = _with(*base, pop) + "SELECT chrom::BIGINT AS chrom, row_id, c::BIGINT AS cluster FROM pop"
    q["a6_cluster_sizes"] = _with(*base, pop) + "SELECT chrom::BIGINT AS chrom, c::BIGINT AS c, count(*) AS n FROM pop GROUP BY 1, 2"
    q["g3_population_fitness"] = _with(*base, pop, _silhouette("pop", True)) + (
        f"SELECT chrom::BIGINT AS chrom, {_r('fitness')} AS fitness FROM sil"
    )
    q["g4_population_sse"] = _with(*base, pop) + f"SELECT chrom::BIGINT AS chrom, {_r('sum(d2)')} AS sse FROM pop GROUP BY chrom"
    q["f4_fitness_rescale"] = _with(*base, pop, _silhouette("pop", True)) + (
        f"SELECT chrom::BIGINT AS chrom, {_r('2.0 * (SELECT max(fitness) FROM sil) - fitness')} AS value FROM sil"
    )
    q["g5_selection"] = _with(*base, pop, _silhouette("pop", True), _select_slots("sil")) + (
        f"SELECT slot::BIGINT AS slot, chrom::BIGINT AS chrom, {_r('fitness')} AS fitness FROM sel"
    )
    q["g7_crossover_children"] = _with(*base, pop, _children(0, 1)) + (
        "SELECT row_id, child1::BIGINT AS child1, child2::BIGINT AS child2 FROM kids"
    )
    q["g7_crossover_rotated"] = _with(*base, pop, f"cut AS (SELECT {_cut(0)} AS cut)") + (
        "SELECT t.row_id, (CASE WHEN t.pos < (SELECT count(*) FROM pts) - (SELECT cut FROM cut) THEN sa.c ELSE sb.c END)::BIGINT AS child "
        "FROM posn t JOIN posn s ON s.pos = (t.pos + (SELECT cut FROM cut)) % (SELECT count(*) FROM pts) "
        "JOIN pop sa ON sa.row_id = s.row_id AND sa.chrom = 0 JOIN pop sb ON sb.row_id = s.row_id AND sb.chrom = 1"
    )
    fam_asg = "famasg AS (SELECT 0 AS chrom, row_id, c FROM pop WHERE chrom = 0 UNION ALL SELECT 1, row_id, c FROM pop WHERE chrom = 1 UNION ALL SELECT 2, row_id, child1 FROM kids UNION ALL SELECT 3, row_id, child2 FROM kids)"
    q["g7_family_competition"] = _with(*base, pop, _children(0, 1), fam_asg, _silhouette("famasg", True)) + (
        f"SELECT place, candidate, fitness FROM (SELECT (row_number() OVER (ORDER BY fitness DESC, chrom) - 1)::BIGINT AS place, "
        f"chrom::BIGINT AS candidate, {_r('fitness')} AS fitness FROM sil) WHERE place < 2"
    )
    mut = f"""{_alias("pop")},
draws AS (SELECT p.chrom, p.row_id, p.c, {_u('mut', 1, "' || p.chrom || '", row_id='p.row_id')} AS um,
                 {_u('draw', 1, "' || p.chrom || '", row_id='p.row_id')} AS ud FROM pop p),
mutated AS ({_drawn(MUT_RATE)})"""
    q["g8_mutation"] = _with(*base, pop, mut) + "SELECT chrom::BIGINT AS chrom, row_id, c::BIGINT AS cluster FROM mutated"

    # KMO twice on the initial population: step 1 keeps labels (they are the
    # nearest-centre labels already) and moves centres to the means; step 2
    # relabels by those means and keeps the candidates when fitness improves.
    kmo = f"""means AS (SELECT a.chrom, a.c, p.j, avg(p.v) AS v FROM pop a JOIN lp p USING (row_id) GROUP BY a.chrom, a.c, p.j
                UNION ALL SELECT chrom, c, j, v FROM pcen pc WHERE NOT EXISTS (SELECT 1 FROM pop a WHERE a.chrom = pc.chrom AND a.c = pc.c)),
cand_d AS (SELECT m.chrom, p.row_id, m.c, sum((p.v - m.v) * (p.v - m.v)) AS d2 FROM lp p JOIN means m ON m.j = p.j GROUP BY m.chrom, p.row_id, m.c),
cand AS (SELECT chrom, row_id, m.c AS c FROM (SELECT chrom, row_id, min({{'d': d2, 'c': c}}) AS m FROM cand_d GROUP BY chrom, row_id))"""
    kmo_tail = """acc AS (SELECT o.chrom, (n.fitness > o.fitness) AS better, o.fitness AS f_old, n.fitness AS f_new FROM silo o JOIN siln n USING (chrom)),
held AS (SELECT p.chrom, p.row_id, CASE WHEN {take} THEN c2.c ELSE p.c END AS c
         FROM pop p JOIN cand c2 ON c2.chrom = p.chrom AND c2.row_id = p.row_id JOIN acc a ON a.chrom = p.chrom)"""
    for key, take in (("g9_kmo_guarded", "a.better"), ("g10_kmo_always", "TRUE")):
        fit_expr = "CASE WHEN a.better THEN a.f_new ELSE a.f_old END" if take != "TRUE" else "a.f_new"
        q[key] = _with(
            *base, pop, kmo, _silhouette("pop", True, "silo"), _silhouette("cand", True, "siln"),
            kmo_tail.format(take=take), _sse_to_means("held", "hsse"),
        ) + (
            f"SELECT a.chrom::BIGINT AS chrom, ({take})::BOOLEAN AS accepted, {_r(fit_expr)} AS fitness, {_r('h.sse')} AS sse "
            "FROM acc a JOIN hsse h USING (chrom)"
        )
    q["g11_fit_one_generation"] = _generations(1)
    q["g11_fit"] = _generations(3)
    q["g11_fit_mutation"] = _generations(2, mutation=MUT_RATE)
    q["g11_fit_always"] = _generations(2, kmo="always")
    log = _with(PTS, pop, _silhouette("pop", True, "silo"), _one_generation(1))
    q["g6_crossover_ring"] = _ring()
    with _sizes(10, 3):  # the defaults
        q["g13_fit_defaults"] = _generations(1)
        q["g6_crossover_ring_p10"] = _ring()
    q["g11_fit_parity"] = _generations(2, parity=True)
    q["g15_population_log"] = log + " UNION ALL ".join(
        f"SELECT {g}::BIGINT AS gen, '{stage}' AS stage, {col}::BIGINT AS chrom, round({fit}, 6) AS fitness FROM {t}"
        for g, stage, col, fit, t in ((0, "init", "chrom", "fitness", "silo"), (1, "selection", "slot", "fitness", "sel_1"),
                                      (1, "crossover", "chrom", "fitness", "crossedfit_1"), (1, "kmo", "chrom", "fit", "acc_1")))
    q["g3_fitness_exact"] = _with(*base, pop, _silhouette("pop", False)) + (
        f"SELECT chrom::BIGINT AS chrom, {_r('fitness')} AS fitness FROM sil"
    )
    q["e8_report_exact"] = q["e8_report"].replace("silhouette_squared", "silhouette_exact").replace(
        _silhouette("asg1", True), _silhouette("asg1", False))

    # far from the origin and one cluster far from all others: nothing may cancel
    part = f"""pts AS (SELECT p_partkey AS row_id, [p_retailprice + {OFFSET}, p_size::DOUBLE] AS x,
                   CASE WHEN p_partkey % 997 = 1 THEN 3 ELSE p_size % 3 END AS c0 FROM part),
far AS (SELECT row_id, CASE WHEN c0 = 3 THEN [x[1] * 100, x[2]] ELSE x END AS x, c0 FROM pts),
asg AS (SELECT 0 AS chrom, row_id, c0 AS c FROM far)"""
    q["a5_sse_offset"] = f"""WITH {part},
m AS (SELECT c0, avg(x[1] - {OFFSET}) AS a, avg(x[2]) AS b FROM far GROUP BY c0)
SELECT round(sum((x[1] - {OFFSET} - a) * (x[1] - {OFFSET} - a) + (x[2] - b) * (x[2] - b)), 3) AS sse FROM far JOIN m USING (c0)"""
    q["e6_silhouette_offset"] = f"WITH {part.replace('pts AS', 'near AS').replace('FROM pts', 'FROM near').replace('far AS', 'pts AS').replace('FROM far', 'FROM pts')},\n" + (
        _silhouette("asg", True) + f" SELECT {_r('fitness')} AS silhouette_squared FROM sil")
    q["s_points_by_position"] = (
        "SELECT count(*) AS n, count(*) AS n_pos, 0::BIGINT AS first, count(*) - 1 AS last, "
        "round(sum(l_quantity), 2) AS quantity FROM lineitem"
    )
    # 2 x 2 covariance: eigenvectors in closed form; the largest loading is positive
    q["d1_pca_part"] = """WITH p AS (SELECT p_partkey AS id, p_size::DOUBLE AS x, p_retailprice AS y FROM part),
m AS (SELECT avg(x) AS mx, avg(y) AS my, var_samp(x) AS a, covar_samp(x, y) AS b, var_samp(y) AS c FROM p),
l AS (SELECT *, (a + c) / 2 + sqrt((a - c) * (a - c) / 4 + b * b) AS l1 FROM m),
u AS (SELECT mx, my, b / sqrt(b * b + (l1 - a) * (l1 - a)) AS ux, (l1 - a) / sqrt(b * b + (l1 - a) * (l1 - a)) AS uy FROM l),
v AS (SELECT mx, my, ux * s AS ux, uy * s AS uy, -uy * t AS wx, ux * t AS wy FROM (
  SELECT *, sign(CASE WHEN abs(ux) > abs(uy) THEN ux ELSE uy END) AS s,
         sign(CASE WHEN abs(uy) > abs(ux) THEN -uy ELSE ux END) AS t FROM u))
SELECT id, round((x - mx) * ux + (y - my) * uy, 3) AS pc1, round((x - mx) * wx + (y - my) * wy, 3) AS pc2 FROM p, v"""
    # the same with centre and label rows: means by two other columns, projected alike
    q["d2_projection"] = q["d1_pca_part"].split("SELECT id, round((x - mx)")[0] + """,
r AS (SELECT 'point' AS kind, id, x, y FROM p
      UNION ALL SELECT 'center', p_size % 4, avg(p_size), avg(p_retailprice) FROM part GROUP BY p_size % 4
      UNION ALL SELECT 'label_center', p_size % 3, avg(p_size), avg(p_retailprice) FROM part GROUP BY p_size % 3)
SELECT kind, id::BIGINT AS id, round((x - mx) * ux + (y - my) * uy, 3) AS pc1, round((x - mx) * wx + (y - my) * wy, 3) AS pc2 FROM r, v"""
    q["s1_numeric_csv"] = "SELECT p_partkey::DOUBLE AS x0, p_size::DOUBLE AS x1, p_retailprice AS x2 FROM part"
    q["s2_named_csv"] = "SELECT c_acctbal AS x0, c_custkey::DOUBLE AS x1, c_nationkey::BIGINT AS label FROM customer"
    q["s4_iris_csv"] = """SELECT (p_size / 10.0)::DOUBLE AS x0, (p_partkey % 7)::DOUBLE AS x1, p_retailprice AS x2, (p_size % 5)::DOUBLE AS x3,
  (p_partkey % 3)::BIGINT AS label FROM part"""
    q["p8_abalone_csv"] = """SELECT ['F', 'I', 'M'][p_partkey % 3 + 1] AS sex, (p_partkey % 3)::DOUBLE AS x0, p_retailprice AS x1, p_size::DOUBLE AS x7,
  CASE WHEN p_size % 29 = 28 THEN 27 ELSE p_size % 29 END::BIGINT AS label FROM part"""
    q["s7_report_file"] = f"""WITH r AS ({q['e8_report']})
SELECT CASE metric WHEN 'sse' THEN 'Final SSE' WHEN 'ari' THEN 'Adjusted Rand Index' WHEN 'label_agreement' THEN 'Jaccard Index'
  WHEN 'fowlkes_mallows' THEN 'Fowlkes Mallows Index' WHEN 'silhouette_squared' THEN 'Silhouette Index (squared)'
  WHEN 'davies_bouldin' THEN 'Davies Bouldin Index' END AS line, value FROM r WHERE metric <> 'pair_jaccard'"""
    # the same statements over events
    for name in ("k_fit_3_iterations", "k_sse_history", "j1_assign", "e2_ari", "e7_davies_bouldin", "a4_label_centers", "r_sample_centers"):
        q[f"{name}_events"] = q[name].replace(PTS, PTS_EVENTS)
    q["k_bounds_events"] = q["k_sse_history_events"]
    return q
