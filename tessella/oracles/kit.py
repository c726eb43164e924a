"""SQL text for the independent checks: the same results written as plain DuckDB queries."""

from __future__ import annotations

from collections.abc import Sequence

RATINGS = """r as materialized (
  select u, i, (case when v < 11 then 1 when v < 26 then 2 when v < 46 then 3 when v < 80 then 4 else 5 end)::double as r
  from (select user_id::bigint as u, json_extract_string(props, '$.k')::bigint as i, max_by(value, event_id) as v
        from events group by 1, 2))"""

FEATURES = """f as materialized (
  select id, case when q > 100 then 's' else 'b' end as label,
         t / 100000 as f0, coalesce(p / 100000, -999) as f1, least(nr, 2)::double as f2,
         coalesce(qr, -999) as f3, coalesce(dr, -999) as f4, case when nr >= 2 then sp else -999 end as f5
  from (select o_orderkey as id, o_totalprice as t, coalesce(sum(l_quantity), 0) as q, sum(l_extendedprice) as p,
               count(*) filter (where l_returnflag = 'R') as nr,
               sum(l_quantity) filter (where l_returnflag = 'R') as qr,
               avg(l_discount) filter (where l_returnflag = 'R') as dr,
               max(l_quantity) filter (where l_returnflag = 'R') - min(l_quantity) filter (where l_returnflag = 'R') as sp
        from orders left join lineitem on l_orderkey = o_orderkey
        group by o_orderkey, o_totalprice))"""

FS = ["f0", "f1", "f2", "f3", "f4", "f5"]

# features with missing values as NULL, and the labels of both kinds
NULLED = "nf as materialized (select id, label, case when label = 'b' then -1.0 else 1.0 end::double as y, " \
    "case when label = 'b' then 0.0 else 1.0 end::double as y01, " + \
    ", ".join(f"nullif({c}, -999) as {c}" for c in FS) + " from f)"

SPLIT = """sp as materialized (
  select u, i, r, row_number() over (partition by u order by md5('988:' || u || ':' || i), i)
                  <= floor(count(*) over (partition by u) * 0.9::double) as is_train from r),
tr as materialized (select u, i, r from sp where is_train),
te as materialized (select u, i, r from sp where not is_train)"""


def sql(select: str, *ctes: str, recursive: bool = False) -> str:
    head = "with recursive " if recursive else "with "
    return head + ",\n".join(ctes) + "\n" + select


def r6(expr: str) -> str:
    return f"(round({expr}, 6) + 0.0)"


def r9(expr: str) -> str:
    """For values that are short decimals, which six digits would cut right at a half."""
    return f"(round({expr}, 9) + 0.0)"


def uniform(text: str) -> str:
    return f"(('0x' || substr(md5({text}), 1, 8))::bigint / 4294967296.0::double)"


def dot(cols: Sequence[str], weights: Sequence[float]) -> str:
    return "(" + " + ".join(f"{c} * {w!r}::double" for c, w in zip(cols, weights)) + ")"


def clip(expr: str) -> str:
    return f"greatest(least({expr}, 5.0::double), 1.0::double)"


def star(expr: str) -> str:
    return clip(f"round_even({expr}, 0)")


def xs(d: int) -> list[str]:
    return [f"x{k}" for k in range(d)]


def moment_cte(name: str, src: str, d: int, y: str = "y", keys: Sequence[str] = (), where: str = "") -> str:
    """One row per key with n, s{i}_{j} (i <= j), t{i} and yy."""
    cells = [f"sum(x{i} * x{j}) as s{i}_{j}" for i in range(d) for j in range(i, d)]
    rights = [f"sum(x{i} * {y}) as t{i}" for i in range(d)]
    group = f" group by {', '.join(keys)}" if keys else ""
    return (f"{name} as materialized (select {''.join(k + ', ' for k in keys)}count(*)::double as n, "
            f"{', '.join(cells + rights)}, sum({y} * {y}) as yy from {src} {where}{group})")


def solve_ctes(name: str, src: str, d: int, keys: Sequence[str] = (), diag: str = "0", left=None, right=None) -> list[str]:
    """Gauss-Jordan elimination written out, one CTE per column; ``name`` ends with keys and w0..w{d-1}."""
    left = left or (lambda i, j: f"s{min(i, j)}_{max(i, j)}")
    right = right or (lambda i: f"t{i}")
    pre = "".join(k + ", " for k in keys)
    cells = [f"({left(i, j)}{f' + {diag}' if i == j else ''})::double as a{i}_{j}" for i in range(d) for j in range(d)]
    out = [f"{name}_0 as materialized (select {pre}{', '.join(cells + [f'({right(i)})::double as b{i}' for i in range(d)])} from {src})"]
    for k in range(d):
        cols = []
        for i in range(d):
            for j in range(k + 1, d):
                cols.append(f"a{k}_{j} / a{k}_{k} as a{k}_{j}" if i == k else
                            f"a{i}_{j} - a{i}_{k} * a{k}_{j} / a{k}_{k} as a{i}_{j}")
            cols.append(f"b{k} / a{k}_{k} as b{k}" if i == k else f"b{i} - a{i}_{k} * b{k} / a{k}_{k} as b{i}")
        out.append(f"{name}_{k + 1} as materialized (select {pre}{', '.join(cols)} from {name}_{k})")
    out.append(f"{name} as materialized (select {pre}{', '.join(f'b{i} as w{i}' for i in range(d))} from {name}_{d})")
    return out


def ridge_ctes(name: str, moments: str, d: int, lam: str, keys: Sequence[str] = ()) -> list[str]:
    return solve_ctes(name, moments, d, keys, f"2 * n * {lam}")


def score(d: int, x: str = "", w: str = "") -> str:
    return "(" + " + ".join(f"{x}x{k} * {w}w{k}" for k in range(d)) + ")"


def weights_out(names: Sequence[str], src: str) -> str:
    """pos, feature, weight rows from a one-row CTE of w0.."""
    return " union all ".join(f"select {k}::int as pos, '{c}' as feature, {r6(f'w{k}')} as weight from {src}"
                              for k, c in enumerate(names))


def prepared(cols: Sequence[str], degree: int, missing: str, scale: bool, name: str = "d",
             extra: str = "") -> tuple[list[str], list[str]]:
    """CTEs of the prepared design ``name(id, y, y01, x0..)`` and the feature names in order."""
    powers = [(c, p) for c in cols for p in range(1, degree + 1)]
    names = ["bias"] + [f"{c}_p{p}" for c, p in powers]
    ctes = [FEATURES, NULLED]
    src = "nf"
    if missing == "median":
        ctes.append("med as materialized (select " + ", ".join(f"median({c}) as {c}" for c in cols) + " from nf)")
        ctes.append("imp as materialized (select id, y, y01, nf.f2 as seg, " +
                    ", ".join(f"coalesce(nf.{c}, med.{c}) as {c}" for c in cols) + " from nf, med)")
        src = "imp"
    raw = ", ".join(f"pow({c}, {p}) as z{k}" for k, (c, p) in enumerate(powers, 1))
    ctes.append(f"wide as materialized (select id, y, y01, {raw}{extra} from {src})")
    n = len(powers)
    if scale:
        ctes.append("sc as materialized (select " + ", ".join(
            f"avg(z{k}) as m{k}, stddev_pop(z{k}) as s{k}" for k in range(1, n + 1)) + " from wide)")
        cells = ", ".join(f"coalesce((z{k} - m{k}) / s{k}, 0) as x{k}" for k in range(1, n + 1))
        ctes.append(f"{name} as materialized (select id, y, y01, 1.0::double as x0, {cells} from wide, sc)")
    else:
        cells = ", ".join(f"z{k} as x{k}" for k in range(1, n + 1))
        ctes.append(f"{name} as materialized (select id, y, y01, 1.0::double as x0, {cells} from wide)")
    return ctes, names


def ranked(name: str, src: str, seed: int) -> str:
    """Rows of ``src`` with their 0-based place in hash order and the row count."""
    return (f"{name} as materialized (select *, row_number() over (order by md5('{seed}:' || id), id) - 1 as k, "
            f"count(*) over () as total from {src})")
