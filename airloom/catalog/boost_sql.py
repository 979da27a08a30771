"""SQL of boosted trees, to hold the trained protocols to: whole features, no sampling."""

from __future__ import annotations

from collections.abc import Sequence

from airloom.operators.trees import LEAST_GAIN, MIN_SIDE, Boosting


def _score(g: str, h: str, s: Boosting) -> str:
    return f"(pow(greatest(abs({g}) - {s.l1}::double, 0), 2) / ({h} + {s.l2}::double))"


def boosted(
    source: str, features: Sequence[str], target: str, s: Boosting, models: str,
    train: str = "part <> m", held: str = "part = m", scale: str | None = None,
) -> str:
    """CTEs from ``source`` (with ``id``, ``part``) to ``predicted``.

    A model is a number ``m`` of ``models``; it trains where ``train`` holds and predicts where
    ``held`` does; its target is scaled over the rows of ``scale``, else its training rows. Splits
    that stay are in k<round>_<level>, leaf values in leaves<round>.
    """
    cells = ", ".join(f"{f}::double as f{i}" for i, f in enumerate(features))
    names = ", ".join(f"f{i}" for i in range(len(features)))
    out = [
        f"cells as materialized (select id, part, {target}::double as y, {cells} from {source})",
        f"models as materialized (select m, avg(y) as mean, case when min(y) < max(y) then stddev_pop(y) else 1 end as deviation from cells, ({models}) where {scale or train} group by m)",
        f"p0 as materialized (select id, m, part, {train} as train, (y - mean) / deviation as z, 0.0::double as pred, {names} from cells, models)",
    ]
    for t in range(s.rounds):
        out.append(f"n{t}_0 as (select *, 0 as node from p{t})")
        for level in range(s.depth):
            node = f"n{t}_{level}"
            sums = " union all ".join(
                f"select m, node, {i} as c, f{i} as v, sum(pred - z) as g, count(*) as h from {node} where train and node >= 0 group by m, node, f{i}"
                for i in range(len(features))
            )
            out += [
                f"h{t}_{level} as materialized ({sums})",
                f"u{t}_{level} as (select *, sum(g) over (partition by m, node, c order by v nulls first) as gu, sum(h) over (partition by m, node, c order by v nulls first) as hu, sum(g) over (partition by m, node, c) as ga, sum(h) over (partition by m, node, c) as ha, coalesce(sum(g) filter (v is null) over (partition by m, node, c), 0) as gm, coalesce(sum(h) filter (v is null) over (partition by m, node, c), 0) as hm from h{t}_{level})",
                f"d{t}_{level} as (select *, gu - case when missing_left then 0 else gm end as gl, hu - case when missing_left then 0 else hm end as hl from u{t}_{level}, (values (true), (false)) as w(missing_left))",
                f"g{t}_{level} as (select *, {_score('gl', 'hl', s)} + {_score('(ga - gl)', '(ha - hl)', s)} - {_score('ga', 'ha', s)} as gain from d{t}_{level} where hl >= {MIN_SIDE} and ha - hl >= {MIN_SIDE})",
                f"b{t}_{level} as materialized (select * from g{t}_{level} where gain > {LEAST_GAIN} qualify row_number() over (partition by m, node order by gain desc, c, v nulls first, missing_left) = 1)",
            ]
            value = "case c " + " ".join(f"when {i} then f{i}" for i in range(len(features))) + " end"
            # Nodes without a split are left alone: marked negative, with their number kept.
            out.append(
                f"n{t}_{level + 1} as materialized (select n.* exclude (node), case when n.node < 0 then n.node when b.m is null then -1 - n.node else 2 * n.node + 1 + case when {value} is null then (not missing_left)::int when v is null then 1 else ({value} > v)::int end end as node from {node} n left join b{t}_{level} b on b.m = n.m and b.node = n.node)"
            )
        # A split stays if it or one below it gains enough.
        for level in reversed(range(s.depth)):
            below = ""
            if level + 1 < s.depth:
                below = f" or exists (select 1 from k{t}_{level + 1} d where d.m = b.m and d.node in (2 * b.node + 1, 2 * b.node + 2))"
            out.append(f"k{t}_{level} as materialized (select * from b{t}_{level} b where gain >= {s.min_gain}{below})")
        # Up from where a row ended to the last node whose parents' splits all stay.
        out.append(_settled(t, s.depth))
        out += [
            f"leaves{t} as materialized (select m, leaf, -{s.rate}::double * sign(sum(pred - z)) * greatest(abs(sum(pred - z)) - {s.l1}::double, 0) / (count(*) + {s.l2}::double) as value from s{t} where train group by m, leaf)",
            f"p{t + 1} as materialized (select r.id, r.m, r.part, r.train, r.z, r.pred + coalesce(l.value, 0) as pred, {', '.join(f'r.f{i}' for i in range(len(features)))} from s{t} r left join leaves{t} l on l.m = r.m and l.leaf = r.leaf)",
        ]
    out.append(f"predicted as materialized (select id, m, pred * deviation + mean as predicted from p{s.rounds} join models using (m) where {held})")
    return ",\n".join(out)


def _settled(t: int, depth: int) -> str:
    """The leaf each row ends in, from the top: a node whose split does not stay is one."""
    stays = " union all ".join(f"select m, node from k{t}_{level}" for level in range(depth))
    ends = "case when node < 0 then -1 - node else node end"
    # The ancestors of a node number: halving, from the root on.
    chain, steps = f"({ends})", []
    for _ in range(depth + 1):
        steps.append(chain)
        chain = f"(({chain} - 1) // 2)"
    options = ", ".join(f"case when {c} >= 0 then {c} end" for c in reversed(steps))
    return (
        f"stays{t} as materialized ({stays}),\n"
        f"e{t} as materialized (select distinct m, node, list_distinct(list_filter([{options}], lambda x: x is not null)) as chain from n{t}_{depth}),\n"
        f"w{t} as materialized (select m, node, min(x) as leaf from (select m, node, unnest(chain) as x from e{t}) c where not exists (select 1 from stays{t} k where k.m = c.m and k.node = c.x) group by m, node),\n"
        f"s{t} as materialized (select n.*, w.leaf from n{t}_{depth} n join w{t} w on w.m = n.m and w.node = n.node)"
    )
