"""Recommender checks in SQL: unrolled epochs, self-joins and window ranks over the ``tr`` and ``te`` tables."""

from __future__ import annotations

from . import kit as k


def gradient(rank: int, epochs: int, gamma: float, reg_u: float, reg_i: float, *, decay: float = 1.0,
             biased: bool = True, implicit: bool = False, spread: float = 0.1, seed: int = 988) -> tuple[list[str], str]:
    """CTEs and the text of the prediction for ``te`` joined to the last tables ``p`` and ``q``."""
    ks = range(rank)

    def draw(kind, col, n):
        u = k.uniform(f"'{seed}:{kind}:' || {col} || ':{n}'")
        return f"(({u} - 0.5::double) * {spread * 12 ** 0.5!r}::double)" if biased else u

    ufs = ", ".join(f"{draw('user', 'u', c)} as f{c}" for c in ks)
    ifs = ", ".join((f"avg(r) as f{c}" if c == 0 and not biased else f"{draw('item', 'i', c)} as f{c}") for c in ks)
    ys = "".join(f", {draw('implicit', 'i', c)} as y{c}" for c in ks) if implicit else ""
    out = [f"mu as materialized (select {'avg(r) as mu from tr' if biased else '0.0::double as mu'})",
           f"p0 as materialized (select u, count(*)::double as n, 0.0::double as b, {ufs} from tr group by u)",
           f"q0 as materialized (select i, count(*)::double as n, 0.0::double as b, {ifs}{ys} from tr group by i)"]
    if implicit:
        out.append("reach as materialized (select i, sum(n) as m from tr join p0 using (u) group by i)")
    pf = [f"(p.f{c} + z.z{c})" if implicit else f"p.f{c}" for c in ks]
    qf = [f"q.f{c}" for c in ks]
    inner = " + ".join(f"{a} * {b}" for a, b in zip(pf, qf))
    est = f"mu + p.b + q.b + {inner}" if biased else inner
    zs = ", ".join(f"sum(y{c}) / sqrt(count(*)) as z{c}" for c in ks)
    one = " + 1" if biased else ""

    def moved(name, key, table, sums, n, reg, vec, bias):
        keep, rate = f"pow(1 - {g * reg!r}::double, {n})", f"(1 - pow(1 - least({g!r}::double * c / {n}, 1), {n})) / c"
        cols = ", ".join(f"{f}{c} * {keep} + {rate} * g{c} as {f}{c}" for c in ks for f in [vec])
        rest = f"{table}.b * {keep} + {rate} * gb as b, " if bias else f"{table}.b, "
        other = "".join(f", f{c}" for c in ks) if vec == "y" else ("".join(f", y{c}" for c in ks) if implicit and key == "i" else "")
        return f"{name} as materialized (select {table}.{key}, {table}.n, {rest}{cols}{other} from {table} join {sums} using ({key}))"

    g = gamma
    for t in range(epochs):
        g /= decay
        z = f" join z{t} z using (u)" if implicit else ""
        if implicit:
            out.append(f"z{t} as materialized (select u, {zs} from tr join q{t} using (i) group by u)")

        def sums(name, key, p, q, met):
            length = " + ".join(f"{v} * {v}" for v in met)
            pulls = ", ".join(f"sum(e * {v}) as g{c}" for c, v in enumerate(f"v{c}" for c in ks))
            vs = ", ".join(f"{v} as v{c}" for c, v in enumerate(met))
            return (f"{name} as materialized (select {key}, sum(e) as gb, sum(l) as c, {pulls} from (select tr.u, tr.i, "
                    f"r - ({est}) as e, {length}{one} as l, {vs} from tr join {p} p using (u) join {q} q using (i){z}, mu) group by {key})")

        out.append(sums(f"si{t}", "i", f"p{t}", f"q{t}", pf))
        out.append(moved(f"q{t}b" if implicit else f"q{t + 1}", "i", f"q{t}", f"si{t}", "n", reg_i, "f", biased))
        q_now = f"q{t}b" if implicit else f"q{t + 1}"
        out.append(sums(f"su{t}", "u", f"p{t}", q_now, qf))
        out.append(moved(f"p{t + 1}", "u", f"p{t}", f"su{t}", "n", reg_u, "f", biased))
        if implicit:
            sq = " + ".join(f"{v} * {v}" for v in qf)
            own = ", ".join(f"sum((r - ({est})) * {v}) / sqrt(count(*)) as s{c}" for c, v in enumerate(qf))
            out.append(f"own{t} as materialized (select tr.u, sum({sq}) as c, {own} from tr join p{t + 1} p using (u) "
                       f"join {q_now} q using (i){z}, mu group by tr.u)")
            hs = ", ".join(f"sum(s{c}) as g{c}" for c in ks)
            out.append(f"sy{t} as materialized (select i, any_value(m) as m, sum(c) as c, {hs} from tr join own{t} using (u) "
                       f"join reach using (i) group by i)")
            out.append(moved(f"q{t + 1}", "i", q_now, f"sy{t}", "m", reg_i, "y", False))
    if implicit:
        out.append(f"z{epochs} as materialized (select u, {zs} from tr join q{epochs} using (i) group by u)")
    z = f" join z{epochs} z using (u)" if implicit else ""
    pred = k.clip(est) if biased else f"({est})"
    return out, (f'select te.u as "user", te.i as item, {k.r6(pred)} as prediction from te join p{epochs} p using (u) '
                 f'join q{epochs} q using (i){z}, mu')


def sequential(rank: int, epochs: int, gamma: float, reg_u: float, reg_i: float, *, decay: float = 1.0, biased: bool = True,
               spread: float = 0.1, seed: int = 988) -> tuple[list[str], str]:
    """Gradient descent one rating after another: a recursive table keyed by vector, of which a step renews two.

    A vector ends with the row's offset, which meets a one; without offsets the entry stays 0.
    """
    def draw(kind, col, n):
        u = k.uniform(f"'{seed}:{kind}:' || {col} || ':{n}'")
        return f"(({u} - 0.5::double) * {spread * 12 ** 0.5!r}::double)" if biased else u

    def start(kind, col):
        cells = ["avg(r)" if c == 0 and kind == "item" and not biased else draw(kind, col, c) for c in range(rank)]
        return f"{kind}s as materialized (select {col}, row_number() over (order by {col}) as pos, [{', '.join(cells)}, 0.0::double] as v " \
               f"from tr group by {col})"

    def moved(vector, met, reg):
        one = f"case when x > {rank} then {'1' if biased else '0'}.0::double else {met} end"
        return f"list_transform({vector}, lambda a, x: a + g * (e * ({one}) - {reg!r}::double * a))"

    new = f"(qv[x] + g * (e * pv[x] - {reg_i!r}::double * qv[x]))"  # the plain rule moves the item first
    offsets = f" - pv[{rank + 1}] - qv[{rank + 1}]" if biased else ""
    return [
        f"mu as materialized (select {'avg(r)' if biased else 'avg(r) * 0'} as mu from tr)", start("user", "u"), start("item", "i"),
        f"line as materialized (select row_number() over (order by ('0x' || substr(md5('{seed}:' || u || ':' || i), 1, 15))::bigint, u, i) "
        "as k, users.pos as uat, items.pos as iat, r, count(*) over () as n from tr join users using (u) join items using (i))",
        "run(kind, pos, v, t) using key (kind, pos) as (select 0, pos, v, 0::bigint from users union all select 1, pos, v, 0 from items "
        "union all select 2, 0, [], 0 union select unnest([0, 1, 2]), unnest([uat, iat, 0]), unnest([pn, qn, []]), t + 1 from ("
        f"select *, {moved('pv', 'qv[x]' if biased else new, reg_u)} as pn, {moved('qv', 'pv[x]', reg_i)} as qn from ("
        f"select c.t, uat, iat, p.v as pv, q.v as qv, {gamma!r}::double / pow({decay!r}::double, c.t // n + 1) as g, "
        f"r - mu{offsets.replace('pv', 'p.v').replace('qv', 'q.v')} - list_inner_product(p.v[1:{rank}], q.v[1:{rank}]) as e "
        "from run c join line on line.k = c.t % n + 1 join recurring.run p on p.kind = 0 and p.pos = uat "
        f"join recurring.run q on q.kind = 1 and q.pos = iat, mu where c.kind = 2 and c.t < n * {epochs})))",
    ], ('select te.u as "user", te.i as item, ' + k.r6(
        (k.clip if biased else str)(f"mu + p.v[{rank + 1}] + q.v[{rank + 1}] + list_inner_product(p.v[1:{rank}], q.v[1:{rank}])"))
        + " as prediction from te join users using (u) join items using (i) join run p on p.kind = 0 and p.pos = users.pos "
          "join run q on q.kind = 1 and q.pos = items.pos, mu")


def weighted_als(rank: int, sweeps: int, reg_u: float, reg_i: float, seed: int = 988) -> tuple[list[str], str]:
    ks = range(rank)
    ifs = ", ".join("avg(r) as f0" if c == 0 else k.uniform(f"'{seed}:item:' || i || ':{c}'") + f" as f{c}" for c in ks)
    out = [f"q0 as materialized (select i, {ifs} from tr group by i)"]

    def half(name, key, other, fixed, reg):
        cells = ", ".join(f"sum(f{a} * f{b})" + (f" + count(*) * {reg!r}::double" if a == b else "") + f" as s{a}_{b}"
                          for a in ks for b in range(a, rank))
        rights = ", ".join(f"sum(r * f{a}) as t{a}" for a in ks)
        out.append(f"{name}m as materialized (select {key}, {cells}, {rights} from tr join {fixed} using ({other}) group by {key})")
        out.extend(k.solve_ctes(f"{name}w", f"{name}m", rank, [key]))
        out.append(f"{name} as materialized (select {key}, {', '.join(f'w{a} as f{a}' for a in ks)} from {name}w)")

    for t in range(sweeps):
        half(f"p{t + 1}", "u", "i", f"q{t}", reg_u)
        half(f"q{t + 1}", "i", "u", f"p{t + 1}", reg_i)
    inner = " + ".join(f"p.f{c} * q.f{c}" for c in ks)
    return out, (f'select te.u as "user", te.i as item, {k.r6(inner)} as prediction from te join p{sweeps} p using (u) '
                 f'join q{sweeps} q using (i)')


def coclustering(ku: int, ki: int, rounds: int, seed: int = 988) -> tuple[list[str], str]:
    def start(col, kind, n):
        return f"(('0x' || substr(md5('{seed}:{kind}:' || {col}), 1, 8))::bigint % {n})::int"

    out = ["mu as materialized (select avg(r) as mu from tr)",
           f"a0 as materialized (select u, avg(r) as um, {start('u', 'user', ku)} as g from tr group by u)",
           f"b0 as materialized (select i, avg(r) as im, {start('i', 'item', ki)} as h from tr group by i)"]
    est = "(ac.m + um - au.m + im - ai.m)"

    def averages(t):
        base = f"tr join a{t} using (u) join b{t} using (i)"
        grid = f"(select unnest(range({ku}))::int as g) x, (select unnest(range({ki}))::int as h) y"
        out.append(f"ac{t} as materialized (select x.g, y.h, coalesce(m, mu) as m from {grid} left join "
                   f"(select g, h, avg(r) as m from {base} group by g, h) c on c.g = x.g and c.h = y.h, mu)")
        out.append(f"au{t} as materialized (select x.g, coalesce(m, mu) as m from (select unnest(range({ku}))::int as g) x left join "
                   f"(select g, avg(r) as m from {base} group by g) c on c.g = x.g, mu)")
        out.append(f"ai{t} as materialized (select y.h, coalesce(m, mu) as m from (select unnest(range({ki}))::int as h) y left join "
                   f"(select h, avg(r) as m from {base} group by h) c on c.h = y.h, mu)")

    for t in range(rounds):
        averages(t)
        out.append(f"a{t + 1} as materialized (select u, any_value(um) as um, arg_min(g, (e, g)) as g from ("
                   f"select u, au.g, any_value(um) as um, sum(pow(r - {est}, 2)) as e from tr join (select u, um from a{t}) using (u) "
                   f"join b{t} b using (i), au{t} au join ac{t} ac on ac.g = au.g join ai{t} ai on ai.h = ac.h "
                   f"where ai.h = b.h group by u, au.g) group by u)")
        out.append(f"b{t + 1} as materialized (select i, any_value(im) as im, arg_min(h, (e, h)) as h from ("
                   f"select i, ai.h, any_value(im) as im, sum(pow(r - {est}, 2)) as e from tr join (select i, im from b{t}) using (i) "
                   f"join a{t + 1} a using (u), ai{t} ai join ac{t} ac on ac.h = ai.h join au{t} au on au.g = ac.g "
                   f"where au.g = a.g group by i, ai.h) group by i)")
    averages(rounds)
    return out, (f'select te.u as "user", te.i as item, {k.r6(k.clip(est))} as prediction from te join a{rounds} a using (u) '
                 f'join b{rounds} b using (i) join ac{rounds} ac on ac.g = a.g and ac.h = b.h '
                 f'join au{rounds} au on au.g = a.g join ai{rounds} ai on ai.h = b.h')


def slope_one(train: str = "tr", name: str = "so", pairs: str = "te") -> list[str]:
    """``{name}(u, i, p)`` for the pairs whose user and item are known."""
    return [f"{name}_dev as materialized (select a.i, b.i as j, avg(a.r - b.r) as d from {train} a join {train} b "
            f"on a.u = b.u and a.i <> b.i group by 1, 2)",
            f"{name} as materialized (select w.u, w.i, {k.clip('m + coalesce(s, 0)')} as p from {pairs} w "
            f"join (select u, avg(r) as m from {train} group by u) using (u) "
            f"left join (select w.u, w.i, avg(d) as s from {pairs} w join {train} t on t.u = w.u "
            f"join {name}_dev d on d.i = w.i and d.j = t.i group by 1, 2) using (u, i))"]


def baselines(epochs: int, reg_u: float, reg_i: float) -> list[str]:
    out = ["mu as materialized (select avg(r) as mu from tr)", "bu0 as (select distinct u, 0.0::double as bu from tr)"]
    for t in range(epochs):
        out.append(f"bi{t + 1} as materialized (select i, sum(r - mu - bu) / ({reg_i!r}::double + count(*)) as bi "
                   f"from tr join bu{t} using (u), mu group by i)")
        out.append(f"bu{t + 1} as materialized (select u, sum(r - mu - bi) / ({reg_u!r}::double + count(*)) as bu "
                   f"from tr join bi{t + 1} using (i), mu group by u)")
    out.append(f"base as materialized (select u, i, mu + bu + bi as b from (select u, i from tr union all select u, i from te) "
               f"join bu{epochs} using (u) join bi{epochs} using (i), mu)")
    return out


def neighbours(k_near: int, entity: str, style: str = "means", *, epochs: int = 3, reg_u: float = 15.0,
               reg_i: float = 10.0, shrinkage: float = 100.0) -> tuple[list[str], str]:
    e, o = ("u", "i") if entity == "user" else ("i", "u")
    out: list[str] = []
    if style == "baseline":
        out += baselines(epochs, reg_u, reg_i)
        out.append(f"t as materialized (select {e} as e, {o} as o, r - b as v, r - b as x from tr join base using (u, i))")
        sim = (f"case when n < 2 or sii < 1e-12 or sjj < 1e-12 then 0 else (n - 1) / (n - 1 + {shrinkage!r}::double) "
               f"* (sij / sqrt(sii * sjj)) end")
    else:
        out.append(f"mn as materialized (select {e} as e, avg(r) as m, stddev_pop(r) as s from tr group by {e})")
        x = "(r - m) / case when s > 0 then s else (select stddev_pop(r) from tr) end" if style == "zscore" else "r - m"
        out.append(f"t as materialized (select {e} as e, {o} as o, r as v, {x} as x from tr join mn on mn.e = tr.{e})")
        vi, vj = "(n * sii - si * si)", "(n * sjj - sj * sj)"
        sim = f"case when n < 2 or {vi} < 1e-12 or {vj} < 1e-12 then 0 else (n * sij - si * sj) / sqrt({vi} * {vj}) end"
    out.append(f"sim as materialized (select i, j, {sim} as w from (select a.e as i, b.e as j, count(*)::double as n, "
               f"sum(a.v) as si, sum(b.v) as sj, sum(a.v * a.v) as sii, sum(b.v * b.v) as sjj, sum(a.v * b.v) as sij "
               f"from t a join t b on a.o = b.o and a.e < b.e group by 1, 2))")
    out.append("link as materialized (select i, j, w from sim where w > 0 union all select j, i, w from sim where w > 0)")
    out.append(f"near as materialized (select e, o, sum(w * x) / sum(w) as s from (select q.{e} as e, q.{o} as o, w, x, "
               f"row_number() over (partition by q.{e}, q.{o} order by w desc, j) as place from te q join t on t.o = q.{o} "
               f"join link on link.i = q.{e} and link.j = t.e) where place <= {k_near} group by 1, 2)")
    if style == "baseline":
        return out, (f'select te.u as "user", te.i as item, {k.r6(k.clip("b + coalesce(near.s, 0)"))} as prediction from te '
                     f'join base using (u, i) left join near on near.e = te.{e} and near.o = te.{o}')
    scale = " * case when mn.s > 0 then mn.s else (select stddev_pop(r) from tr) end" if style == "zscore" else ""
    return out, (f'select te.u as "user", te.i as item, {k.r6(k.clip(f"m + coalesce(near.s, 0){scale}"))} as prediction from te '
                 f'join mn on mn.e = te.{e} left join near on near.e = te.{e} and near.o = te.{o}')
