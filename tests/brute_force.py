"""Row-by-row fill of a pool, written from its definition; for small fixtures only."""

import math
from decimal import ROUND_HALF_UP, Decimal

UNITS = 10_000_000


def fill(rows, pool):
    """rows in order: (candidate, wanted, [(limit type, value, allowed units)]) -> outcome per row."""
    pool = Decimal(pool)
    used, out, filled = {}, [], Decimal(0)
    for candidate, wanted, limits in rows:
        if filled >= pool:
            out.append(("unvisited", Decimal(0), None))
            continue
        rooms = {(t, v): max(allowed - used.get((t, v), 0), 0) for t, v, allowed in limits}
        taken, why = Decimal(0), None
        if candidate and min(rooms.values(), default=UNITS) > 0:
            by_limits = [(pool * room / UNITS).quantize(Decimal("0.0001"), ROUND_HALF_UP) for room in rooms.values()]
            taken = min([Decimal(wanted), pool - filled, *by_limits])
            filled += taken
            units = math.floor(float(taken) * UNITS / float(pool) + 0.5)
            for key in rooms:
                used[key] = used.get(key, 0) + units
        elif candidate:
            kind, value, allowed = [x for x in limits if rooms[x[0], x[1]] == 0][-1]
            why = ("pool limit 0" if allowed == 0 else "pool limit used up", f"{kind}-{value}")
        out.append(("visited", taken, why))
    return out
