"""Independent oracle: a plain-Python sequential replay of the packet rules (small data only)."""

from __future__ import annotations

ABSENT = object()


def replay(base_rows: dict, packets: list[dict], key: str, not_null: set, defaults: dict, columns: list[str]):
    """Apply packets one by one in seq order. Returns (table dict, outcome per seq)."""
    table = {k: dict(v) for k, v in base_rows.items()}
    out = {}
    for p in sorted(packets, key=lambda p: p["seq"]):
        a, data, restr = p["action"], p.get("data") or {}, p.get("restriction") or {}
        data = {c: v for c, v in data.items() if c in columns}
        k = data.get(key) if a in ("add", "set") else restr.get(key)
        live = k in table
        nn_null = any(c in data and data[c] is None for c in not_null)
        nn_missing = any(c not in data and c not in defaults for c in not_null)
        if a == "add":
            if nn_null or nn_missing or k is None:
                out[p["seq"]] = "rejected"
            elif live:
                out[p["seq"]] = "rejected"
            else:
                table[k] = {c: data.get(c, defaults.get(c)) for c in columns}
                out[p["seq"]] = "inserted"
        elif a == "set":
            if nn_null:
                out[p["seq"]] = "quarantined" if live else "rejected"
            elif live:
                table[k].update({c: v for c, v in data.items() if c != key})
                out[p["seq"]] = "updated"
            elif nn_missing:
                out[p["seq"]] = "rejected"
            else:
                table[k] = {c: data.get(c, defaults.get(c)) for c in columns}
                out[p["seq"]] = "inserted"
        elif a == "update":
            if nn_null:
                out[p["seq"]] = "quarantined" if live else "noop"
            elif live:
                table[k].update({c: v for c, v in data.items() if c != key})
                out[p["seq"]] = "updated"
            else:
                out[p["seq"]] = "noop"
        elif a == "delete":
            if live:
                del table[k]
                out[p["seq"]] = "deleted"
            else:
                out[p["seq"]] = "noop"
    return table, out
