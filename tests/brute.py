"""Plain-Python loops over single rows, written from the planning rules; used as oracles."""

from __future__ import annotations

import math

LOW, BIG_T, BIG_F = 30000.0, 5e6, 0.01
BANDS = [(0.05, "to_5"), (0.1, "to_10"), (0.15, "to_15"), (0.2, "to_20"), (0.25, "to_25")]
STEPS = ["very_low", "to_5", "to_10", "to_15", "to_20", "to_25"]


def share_after(f, step, p):
    reach = STEPS.index(step)
    if step == "to_20":
        reach = 3
    new = f
    if 0 <= f < 0.01:
        new = f * p.very_low
    elif f >= 0.01:
        low = 0.01
        for k, (high, name) in enumerate(BANDS):
            if low <= f < high and k < reach:
                new = getattr(p, name)
            low = high
    if step != "very_low" and f < 0.25 and new > 0.25:
        new = 0.25
    return new


def share(t, s):
    return t / s if s else 1.0


def pull(base, raised, plan):
    gap, gain = plan - sum(base), sum(raised) - sum(base)
    return [b + (r - b) * gap / gain if gain else b for b, r in zip(base, raised)]


def fill_big(t, f, plan):
    weight = sum(x for x, y in zip(t, f) if x > BIG_T and y > BIG_F)
    gap = plan - sum(t)
    return [x + x / weight * gap if x > BIG_T and y > BIG_F else x for x, y in zip(t, f)]


def one_attempt(rows, plan, p, years):
    """rows: (segment, target, soz). Returns (stage, targets)."""
    t = [r[1] for r in rows]
    s = [r[2] for r in rows]
    f = [share(a, b) for a, b in zip(t, s)]
    weight = sum(x for x, y in zip(t, f) if x > BIG_T and y > BIG_F)
    gap = plan - sum(t)
    if weight and 0 < gap / weight < 0.24:
        return "big_init", fill_big(t, f, plan)
    if sum(t) and plan / sum(t) < 1:
        return "scale", [x * plan / sum(t) for x in t]
    for step in STEPS:
        c = [share_after(y, step, p) * z for y, z in zip(f, s)]
        if sum(c) > plan:
            return step, pull(t, c, plan)
    f = [share_after(y, "to_25", p) for y in f]
    t = [y * z for y, z in zip(f, s)]
    raised, shares = list(t), list(f)
    for n in range(25, 99):
        start = 0.250001 if n == 25 else n / 100
        for k, y in enumerate(f):
            if start <= y <= start + 0.009999:
                shares[k] = start + p.band_step
                raised[k] = shares[k] * s[k]
        if sum(raised) > plan:
            return "bands", pull(t, raised, plan)
    t, f = raised, shares
    if 1 - sum(t) / plan <= p.big_gap:
        weight = sum(x for x, y in zip(t, f) if x > BIG_T and y > BIG_F)
        return "big_finish", fill_big(t, f, plan) if weight else t
    for q in range(30, 80):
        u = []
        for (segment, _, _), x in zip(rows, t):
            own = quantile(years.get(segment), q / 100)
            u.append(x if x in (0.0, LOW) else max(x, x if own is None else own))
        if sum(u) > plan:
            return "quantile", pull(t, u, plan)
    f = [share(x, z) for x, z in zip(u, s)]
    if 1 - sum(u) / plan <= p.big_gap:
        weight = sum(x for x, y in zip(u, f) if x > BIG_T and y > BIG_F)
        return "big_last", fill_big(u, f, plan) if weight else u
    return "failed", u


def quantile(values, p):
    if values is None:
        return None
    values = sorted(list(values) + [0.0] * (13 - len(values)))
    at = p * 12
    low = math.floor(at)
    return values[low] + (values[min(low + 1, 12)] - values[low]) * (at - low)


def allocate_branch(rows, plan, levels, years):
    for p in levels:
        stage, targets = one_attempt(rows, plan, p, years)
        if stage != "failed" or p is levels[-1]:
            return p.level, stage, targets


def own_attempt(rows, plan, step, border=0.03):
    """rows: dicts with target, rel, entire_mean, greatest. Returns (stage, band, targets)."""
    t = [r["target"] for r in rows]
    if sum(t) and plan / sum(t) < 1:
        return "scale", None, [x * plan / sum(t) for x in t]
    filled, rel = [], []
    for r in rows:
        if r["rel"] < border:
            value = border / r["rel"] * r["target"] if r["rel"] else r["target"]
            filled.append(min(value, r["greatest"]))
            rel.append(1.0 if r["target"] <= 500 else r["rel"])
        else:
            filled.append(r["target"])
            rel.append(r["rel"])
    if sum(filled) > plan:
        return "border", None, pull(t, filled, plan)
    for n in range(3, 97):
        start = border + 0.001 if n == 3 else n / 100
        for k, r in enumerate(rows):
            if start <= rel[k] <= start + 0.009999 and r["target"] > 500:
                rel[k] = start + step
        value = [
            min(r["target"] if r["entire_mean"] == 0 else x * r["entire_mean"], r["greatest"])
            for x, r in zip(rel, rows)
        ]
        if sum(value) > plan:
            return "ratchet", n, pull(t, value, plan)
    return "failed", None, value
