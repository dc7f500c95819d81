"""SQL twins of the iterative models, built from repeated common table expressions."""

from __future__ import annotations

from collections.abc import Sequence

from panelspark.plans.registry import q6


#: The twins' own search: logs of the first ratios tried, and how often the step around the best is divided by ten.
_LOGS = range(-12, 13)
_ZOOMS = 7


def f_tail(f: str, df1: str, df2: str, steps: int = 2000) -> str:
    """P(F > f) by Simpson's rule over the density of the root of F."""
    top = f"least(sqrt(greatest({f}, 0)), 60)"
    x = f"({top} * i / {steps})"
    weight = f"CASE WHEN i = 0 OR i = {steps} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    body = f"{weight} * 2 * pow({x}, {df1} - 1) * pow(1 + {df1} * {x} * {x} / {df2}, -({df1} + {df2}) / 2)"
    scale = f"pow({df1} / {df2}, {df1} / 2) * exp(lgamma(({df1} + {df2}) / 2) - lgamma({df1} / 2) - lgamma({df2} / 2))"
    return f"(1 - {scale} * {top} / {3 * steps} * list_sum([{body} for i in range({steps + 1})]))"


def t_tail(t: str, df: str) -> str:
    """Two-sided tail of Student's t."""
    return f_tail(f"({t}) * ({t})", "1.0", df)


def eliminate(source: str, xs: Sequence[str], y: str, tag: str) -> str:
    """CTEs that solve least squares of ``y`` on ``xs`` with an intercept by symmetric elimination.

    The last CTE ``<tag>_fit`` has n, b0, b1.., rss and tss.
    """
    names = [*xs, y]
    q, p = len(names), len(xs)
    cells = [(i, j) for i in range(q) for j in range(i, q)]
    sums = ", ".join(f"covar_pop({names[i]}, {names[j]}) * count(*) AS s{i}_{j}" for i, j in cells)
    means = ", ".join(f"avg({v}) AS m{i}" for i, v in enumerate(names))
    parts = [f"{tag}_0 AS (SELECT CAST(count(*) AS DOUBLE) AS n, {means}, {sums} FROM {source})"]
    kept = ["n", *[f"m{i}" for i in range(q)], f"s{p}_{p} AS tss"]
    for k in range(p):
        pivots = [f"s{k}_{j} AS u{k}_{j}" for j in range(k, q)]
        rest = [f"s{i}_{j} - s{k}_{i} * s{k}_{j} / s{k}_{k} AS s{i}_{j}" for i, j in cells if i > k]
        parts.append(f"{tag}_{k + 1} AS (SELECT {', '.join([*kept, *pivots, *rest])} FROM {tag}_{k})")
        if k == 0:
            kept = ["n", *[f"m{i}" for i in range(q)], "tss"]
        kept += [f"u{k}_{j}" for j in range(k, q)]
    kept.append(f"s{p}_{p} AS rss")
    previous = f"{tag}_{p}"
    for k in reversed(range(p)):
        known = "".join(f" - u{k}_{j} * b{j + 1}" for j in range(k + 1, p))
        parts.append(f"{tag}_b{k + 1} AS (SELECT {', '.join(kept)}, (u{k}_{p}{known}) / u{k}_{k} AS b{k + 1} FROM {previous})")
        kept = [c.split(" AS ")[-1] for c in kept] + [f"b{k + 1}"]
        previous = f"{tag}_b{k + 1}"
    b0 = f"m{p}" + "".join(f" - b{i + 1} * m{i}" for i in range(p))
    slopes = ", ".join(f"b{i + 1}" for i in range(p))
    parts.append(f"{tag}_fit AS (SELECT n, {b0} AS b0, {slopes}, rss, tss FROM {previous})")
    return ",\n".join(parts)


def two_way(source: str, columns: Sequence[str], rounds: int = 60) -> str:
    """CTEs that take unit and period means out of the columns in turn; ``tw(unit, <c>...)`` holds what remains."""
    kept = ", ".join(columns)
    parts = [f"tw_0 AS MATERIALIZED (SELECT unit, period, {kept} FROM {source})"]
    for r in range(rounds):
        for half, key in (("a", "unit"), ("b", "period")):
            before = f"tw_{r}" if half == "a" else f"tw_{r}a"
            after = f"tw_{r}a" if half == "a" else f"tw_{r + 1}"
            out = ", ".join(f"{c} - avg({c}) OVER (PARTITION BY {key}) AS {c}" for c in columns)
            parts.append(f"{after} AS MATERIALIZED (SELECT unit, period, {out} FROM {before})")
    out = ", ".join(f"{c} - avg({c}) OVER (PARTITION BY unit) AS {c}" for c in columns)
    parts.append(f"tw AS (SELECT unit, {out} FROM tw_{rounds})")
    return ",\n".join(parts)


def mixed(source: str, nested: bool, rounds: int = _ZOOMS) -> str:
    """CTEs for the random-intercept model with one regressor over ``source(grp, stratum, unit, x, y)``.

    The last CTE ``mixed_fit`` has one row per ``grp`` with the ratios, the weighted matrix and the coefficients.
    """
    parts = [
        f"centre AS (SELECT grp, avg(x) AS cx, avg(y) AS cy, CAST(count(*) AS DOUBLE) AS nn, count(DISTINCT unit) AS units "
        f"FROM {source} GROUP BY grp)",
        f"""un AS (
  SELECT grp, stratum, CAST(count(*) AS DOUBLE) AS n, avg(x) - any_value(cx) AS dx, avg(y) - any_value(cy) AS dy,
         var_pop(x) * count(*) AS cxx, covar_pop(x, y) * count(*) AS cxy, var_pop(y) * count(*) AS cyy
  FROM {source} JOIN centre USING (grp) GROUP BY grp, stratum, unit)""",
    ]
    coarse = "[0.0::DOUBLE, " + ", ".join(f"exp({k}::DOUBLE)" for k in _LOGS) + "]"
    second = coarse if nested else "[0.0::DOUBLE]"
    parts += [
        f"g1_0 AS (SELECT grp, unnest({coarse}) AS t1 FROM centre)",
        f"g2_0 AS (SELECT grp, unnest({second}) AS t2 FROM centre)",
    ]
    for r in range(rounds + 1):
        parts += _round(r)
        if r < rounds:
            step = 10.0 ** -(r + 1)
            for dim in (1, 2):
                if dim == 2 and not nested:
                    parts.append(f"g2_{r + 1} AS (SELECT grp, 0.0::DOUBLE AS t2 FROM centre)")
                    continue
                low = ", ".join(f"exp({_LOGS[0] - k}::DOUBLE)" for k in (2, 1, 0))
                parts.append(
                    f"g{dim}_{r + 1} AS (SELECT grp, unnest(CASE WHEN t{dim} = 0 THEN [0.0::DOUBLE, {low}] ELSE "
                    f"list_concat([0.0::DOUBLE], [exp(ln(t{dim}) + {step} * k) for k in range(-10, 11)]) END) "
                    f"AS t{dim} FROM best_{r})"
                )
    parts.append(f"mixed_fit AS (SELECT best_{rounds}.*, cx, cy, nn, units FROM best_{rounds} JOIN centre USING (grp))")
    return ",\n".join(parts)


def _round(r: int) -> list[str]:
    a = "(n / (1 + n * t1))"
    strata = f"""st_{r} AS (
  SELECT grp, t1, stratum, sum({a}) AS a, sum({a} * dx) AS ux, sum({a} * dy) AS uy, sum(cxx + {a} * dx * dx) AS vxx,
         sum(cxy + {a} * dx * dy) AS vxy, sum(cyy + {a} * dy * dy) AS vyy, sum(ln(1 + n * t1)) AS ld
  FROM un JOIN g1_{r} USING (grp) GROUP BY grp, t1, stratum)"""
    k = "(t2 / (1 + t2 * a))"
    whole = f"""w_{r} AS (
  SELECT grp, t1, t2, sum(a - {k} * a * a) AS m00, sum(ux - {k} * a * ux) AS m0x, sum(uy - {k} * a * uy) AS m0y,
         sum(vxx - {k} * ux * ux) AS mxx, sum(vxy - {k} * ux * uy) AS mxy, sum(vyy - {k} * uy * uy) AS myy,
         sum(ld + ln(1 + t2 * a)) AS ld
  FROM st_{r} JOIN g2_{r} USING (grp) GROUP BY grp, t1, t2)"""
    solved = f"""f_{r} AS (
  SELECT *, m00 * mxx - m0x * m0x AS det, (m00 * mxy - m0x * m0y) / (m00 * mxx - m0x * m0x) AS b1 FROM w_{r})"""
    fitted = f"h_{r} AS (SELECT *, (m0y - m0x * b1) / m00 AS b0 FROM f_{r})"
    valued = f"""v_{r} AS (
  SELECT h_{r}.*, myy - b0 * m0y - b1 * mxy AS rss, (nn - 2) * ln(myy - b0 * m0y - b1 * mxy) + ld + ln(det) AS value
  FROM h_{r} JOIN centre USING (grp))"""
    best = f"""best_{r} AS (
  SELECT * FROM v_{r} QUALIFY row_number() OVER (PARTITION BY grp ORDER BY value, t1, t2) = 1)"""
    return [strata, whole, solved, fitted, valued, best]


def mixed_coefficients(by: str | None = None) -> str:
    """Final SELECT over ``mixed_fit``: intercept and slope with standard errors."""
    key = f"grp AS {by}, " if by else ""
    s2 = "(rss / (nn - 2))"
    head = key and "grp, "
    return f"""
, mixed_terms AS (
  SELECT grp, '(Intercept)' AS term, b0 - b1 * cx + cy AS est, sqrt({s2} * (mxx + 2 * cx * m0x + cx * cx * m00) / det) AS se, nn
  FROM mixed_fit UNION ALL SELECT grp, 'x', b1, sqrt({s2} * m00 / det), nn FROM mixed_fit)
SELECT {key or head}term, {q6('est')} AS estimate, {q6('se')} AS std_error, {q6('est / se', 3)} AS statistic, nn - 2 AS df,
       {q6(t_tail('est / se', '(nn - 2)'), 5)} AS p_value, CAST(nn AS BIGINT) AS n_obs, 'ok' AS status FROM mixed_terms"""


def gee(source: str, rounds: int = 12) -> str:
    """CTEs for the AR(1) estimating equations with one regressor over ``source(unit, period, x, y)``.

    ``gee_fit`` has alpha, scale and coefficients; ``gee_meat`` the unit-clustered score products.
    """
    pairs = {"00": ("1", "1"), "0x": ("1", "x"), "0y": ("1", "y"), "xx": ("x", "x"), "xy": ("x", "y"), "yy": ("y", "y")}
    prior = {"1": "1", "x": "px", "y": "py"}
    sums = []
    for name, (i, j) in pairs.items():
        sums += [
            f"coalesce(sum({i} * {j}) FILTER (px IS NULL), 0) AS f{name}",
            f"coalesce(sum({i} * {j}) FILTER (px IS NOT NULL), 0) AS l{name}",
            f"coalesce(sum({i} * {prior[j]} + {j} * {prior[i]}) FILTER (px IS NOT NULL), 0) AS s{name}",
            f"coalesce(sum({prior[i]} * {prior[j]}) FILTER (px IS NOT NULL), 0) AS c{name}",
        ]
    columns = ", ".join(sums)
    names = [f"{kind}{name}" for name in pairs for kind in "flsc"]

    def m(name: str, rho: str = "rho") -> str:
        return f"(f{name} + (l{name} - {rho} * s{name} + {rho} * {rho} * c{name}) / (1 - {rho} * {rho}))"

    def quadratic(kind: str) -> str:
        return (
            f"({kind}yy - 2 * b0 * {kind}0y - 2 * b1 * {kind}xy + b0 * b0 * {kind}00 + 2 * b0 * b1 * {kind}0x "
            f"+ b1 * b1 * {kind}xx)"
        )

    parts = [
        f"gc AS (SELECT avg(x) AS cx, avg(y) AS cy FROM {source})",
        f"gd AS (SELECT unit, period, x - cx AS x, y - cy AS y FROM {source}, gc)",
        "gl AS (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py FROM gd WINDOW w AS (PARTITION BY unit ORDER BY period))",
        f"gu AS (SELECT unit, count(*) AS n, {columns} FROM gl GROUP BY unit)",
        "gt AS (SELECT CAST(sum(n) AS DOUBLE) AS n, " + ", ".join(f"sum({c}) AS {c}" for c in names) + " FROM gu)",
        "gr_0 AS (SELECT 0.0::DOUBLE AS rho)",
    ]
    det = f"({m('00')} * {m('xx')} - {m('0x')} * {m('0x')})"
    for r in range(rounds + 1):
        parts.append(
            f"gb_{r} AS (SELECT gt.*, rho, ({m('00')} * {m('xy')} - {m('0x')} * {m('0y')}) / {det} AS b1, "
            f"({m('xx')} * {m('0y')} - {m('0x')} * {m('xy')}) / {det} AS b0 FROM gt, gr_{r})"
        )
        scale = f"(({quadratic('f')} + {quadratic('l')}) / (n - 2))"
        parts.append(f"gr_{r + 1} AS (SELECT ({quadratic('s')} / 2) / ((l00 - 2) * {scale}) AS rho FROM gb_{r})")
    parts.append(
        f"gee_fit AS (SELECT rho, b0, b1, n, (({quadratic('f')} + {quadratic('l')}) / (n - 2)) AS scale, "
        f"{m('00')} AS m00, {m('0x')} AS m0x, {m('xx')} AS mxx, cx, cy FROM gb_{rounds}, gc)"
    )
    score0 = f"{m('0y')} - {m('00')} * b0 - {m('0x')} * b1"
    score1 = f"{m('xy')} - {m('0x')} * b0 - {m('xx')} * b1"
    parts.append(
        "gee_meat AS (SELECT sum(s0 * s0) AS j00, sum(s0 * s1) AS j01, sum(s1 * s1) AS j11 FROM ("
        f"SELECT {score0} AS s0, {score1} AS s1 FROM gu, (SELECT rho, b0, b1 FROM gee_fit)))"
    )
    parts.append(
        "gee_cov AS (SELECT *, m00 * mxx - m0x * m0x AS det FROM gee_fit, gee_meat)"
    )
    parts.append(
        "gee_var AS (SELECT *, (mxx * mxx * j00 - 2 * mxx * m0x * j01 + m0x * m0x * j11) / (det * det) AS v00, "
        "(-mxx * m0x * j00 + (mxx * m00 + m0x * m0x) * j01 - m0x * m00 * j11) / (det * det) AS v01, "
        "(m0x * m0x * j00 - 2 * m0x * m00 * j01 + m00 * m00 * j11) / (det * det) AS v11 FROM gee_cov)"
    )
    return ",\n".join(parts)


def gee_power(source: str, rounds: int = 8, steps: int = 20) -> str:
    """CTEs for the estimating equations with alpha to the power of the gap between periods, one regressor.

    The sign of the estimating function of alpha is looked up at even steps, and again inside the step where it turns.
    """
    pairs = {"00": ("1", "1"), "0x": ("1", "x"), "0y": ("1", "y"), "xx": ("x", "x"), "xy": ("x", "y"), "yy": ("y", "y")}
    prior = {"1": "1", "x": "px", "y": "py"}

    def crossed(first: dict[str, str], second: dict[str, str]) -> dict[str, str]:
        return {name: f"{first[i]} * {second[j]}" for name, (i, j) in pairs.items()}

    own = {"1": "1", "x": "x", "y": "y"}
    now, past = crossed(own, own), crossed(prior, prior)
    between = {name: f"({prior[i]} * {own[j]} + {own[i]} * {prior[j]})" for name, (i, j) in pairs.items()}
    by_gap = ", ".join(
        f"sum({now[name]}) AS l{name}, sum({between[name]}) AS s{name}, sum({past[name]}) AS c{name}" for name in pairs
    )
    quadratic = "({k}yy - 2 * b0 * {k}0y - 2 * b1 * {k}xy + b0 * b0 * {k}00 + 2 * b0 * b1 * {k}0x + b1 * b1 * {k}xx)"
    weighted = ", ".join(
        f"any_value(f{name}) + sum((l{name} - pow(rho, gap) * s{name} + pow(rho, 2 * gap) * c{name}) / (1 - pow(rho, 2 * gap))) "
        f"AS m{name}, sum(gap * pow(rho, gap - g0) * s{name}) AS t{name}, any_value(w{name}) AS w{name}" for name in pairs
    )
    solved = (
        "*, (m00 * mxy - m0x * m0y) / (m00 * mxx - m0x * m0x) AS b1, (mxx * m0y - m0x * mxy) / (m00 * mxx - m0x * m0x) AS b0"
    )

    def fits(r: str, trials: str) -> list[str]:
        return [
            f"""pm_{r} AS (
  SELECT rho, w, any_value(n) AS n, any_value(n_pairs) AS n_pairs, {weighted},
         sum(gap * pow(rho, gap - g0) * pow(rho, gap) * g.n_gap) AS steep FROM {trials}, pg g, pw GROUP BY rho, w)""",
            f"pb_{r} AS (SELECT {solved} FROM pm_{r})",
            f"pf_{r} AS (SELECT *, {quadratic.format(k='w')} / (n - 2) AS scale FROM pb_{r})",
        ]

    parts = [
        f"pc AS (SELECT avg(x) AS cx, avg(y) AS cy FROM {source})",
        f"pd AS (SELECT unit, period, x - cx AS x, y - cy AS y FROM {source}, pc)",
        "pl AS (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py, CAST(period - lag(period) OVER w AS DOUBLE) AS gap "
        "FROM pd WINDOW w AS (PARTITION BY unit ORDER BY period))",
        f"pg AS (SELECT gap, count(*) AS n_gap, {by_gap} FROM pl WHERE gap IS NOT NULL GROUP BY gap)",
        "pfirst AS (SELECT " + ", ".join(f"coalesce(sum({v}), 0) AS f{name}" for name, v in now.items()) + " FROM pl WHERE gap IS NULL)",
        "pall AS (SELECT CAST(count(*) AS DOUBLE) AS n, " + ", ".join(f"sum({v}) AS w{name}" for name, v in now.items()) + " FROM pd)",
        "pw AS (SELECT pfirst.*, pall.*, n_pairs, g0 FROM pfirst, pall, "
        "(SELECT CAST(sum(n_gap) AS DOUBLE) AS n_pairs, min(gap) AS g0 FROM pg))",
        "pr_0 AS (SELECT 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi)",
    ]
    for r in range(1, rounds + 1):
        parts.append(
            f"pt_{r} AS (SELECT lo + (hi - lo) * i / {steps} AS rho, (hi - lo) / {steps} AS w FROM pr_{r - 1}, range({steps}) AS s(i))"
        )
        parts += fits(str(r), f"pt_{r}")
        turn = f"{quadratic.format(k='t')} / 2 / scale - (n_pairs - 2) / n_pairs * steep > 0"
        parts.append(f"pr_{r} AS (SELECT max(rho) FILTER (WHERE {turn}) AS lo, max(rho) FILTER (WHERE {turn}) + any_value(w) AS hi FROM pf_{r})")
    parts.append(f"pt_z AS (SELECT (lo + hi) / 2 AS rho, 0.0 AS w FROM pr_{rounds})")
    parts += fits("z", "pt_z")

    def score(z: str, pz: str) -> str:
        whole = f"({z} * (y - b0 - b1 * x))"
        cross = f"({z} * (py - b0 - b1 * px) + {pz} * (y - b0 - b1 * x))"
        behind = f"({pz} * (py - b0 - b1 * px))"
        return (
            f"sum(CASE WHEN gap IS NULL THEN {whole} ELSE ({whole} - pow(rho, gap) * {cross} + pow(rho, 2 * gap) * {behind}) "
            f"/ (1 - pow(rho, 2 * gap)) END)"
        )

    parts.append(f"ps AS (SELECT unit, {score('1', '1')} AS s0, {score('x', 'px')} AS s1 FROM pl, pf_z GROUP BY unit)")
    parts.append("pj AS (SELECT sum(s0 * s0) AS j00, sum(s0 * s1) AS j01, sum(s1 * s1) AS j11 FROM ps)")
    parts.append(
        "gee_power AS (SELECT rho, scale, b1, CAST(n AS BIGINT) AS n, sqrt((m0x * m0x * j00 - 2 * m0x * m00 * j01 + m00 * m00 * j11) "
        "/ pow(m00 * mxx - m0x * m0x, 2)) AS se1 FROM pf_z, pj)"
    )
    return ",\n".join(parts)
