"""A plain sequential engine: one packet after the other on a list of rows, for any contract without computed defaults."""

from __future__ import annotations


def run(base: list[tuple], log: list[tuple], contract):
    """``log``: (seq, action, data, restriction) with text values. Returns the rows, sorted, and seq -> (outcome, rows hit)."""
    names, key, types = contract.names, list(contract.primary_key), dict(contract.columns)
    rows = [dict(zip(names, r, strict=True)) for r in base]
    out, made = {}, []

    def typed(part):
        return {c: None if v is None else int(v) if types[c] in ("bigint", "int") else v for c, v in (part or {}).items() if c in types}

    def unique_ok(row, others):
        for uk in contract.unique_keys:
            mine = [row[c] for c in uk]
            if None not in mine and any([o[c] for c in uk] == mine for o in others):
                return False
        return True

    def hits(part):
        return [r for r in rows if all(v is not None and r[c] == v for c, v in part.items())]

    def insert(seq, data):
        if any(c in data and data[c] is None for c in (*contract.required, *key)) or any(c not in data and c not in contract.defaults for c in contract.required):
            return "rejected", 0
        row = {c: data.get(c, contract.defaults.get(c)) for c in names}
        if contract.surrogate and contract.surrogate not in data:
            row[contract.surrogate] = ("new", seq)
        elif any(k not in data for k in key):
            return "rejected", 0
        if any(all(r[k] == row[k] for k in key) for r in rows) or not unique_ok(row, rows):
            return "rejected", 0
        if contract.surrogate and isinstance(row[contract.surrogate], tuple):
            made.append(row)
        rows.append(row)
        return "inserted", 1

    def write(found, data):
        """All rows or none."""
        if not found:
            return "noop", 0
        if any(c in data and data[c] is None for c in (*contract.required, *key)):
            return "quarantined", 0
        rest = [r for r in rows if not any(r is f for f in found)]
        new = [r | data for r in found]
        for i, r in enumerate(new):
            others = [*rest, *new[:i]]
            if any(all(o[k] == r[k] for k in key) for o in others) or not unique_ok(r, others):
                return "quarantined", 0
        for f, r in zip(found, new, strict=True):
            f.update(r)
        return "updated", len(found)

    for seq, action, data, restriction in sorted(log, key=lambda p: p[0]):
        data, restriction = typed(data), typed(restriction)
        if action == "add":
            out[seq] = insert(seq, data)
        elif action == "set":
            part = {k: data[k] for k in key if k in data}
            if not part:
                uk = next((u for u in contract.unique_keys if all(c in data for c in u)), ())
                part = {c: data[c] for c in uk}
            found = hits(part) if part else []
            out[seq] = write(found, {c: v for c, v in data.items() if c not in part}) if found else insert(seq, data)
        elif action == "update":
            out[seq] = write(hits(restriction), data)
        else:
            found = hits(restriction)
            rows[:] = [r for r in rows if not any(r is f for f in found)]
            out[seq] = ("deleted", len(found)) if found else ("noop", 0)
    if contract.surrogate:
        top = max((r[names.index(contract.surrogate)] for r in base), default=0)
        for i, r in enumerate(sorted(made, key=lambda r: r[contract.surrogate][1] if isinstance(r[contract.surrogate], tuple) else 0)):
            r[contract.surrogate] = top + 1 + i
    return sorted((tuple(r[c] for c in names) for r in rows), key=str), out
