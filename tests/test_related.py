"""Parents and children in one ordered log, against a sequential replay."""

import random

import pytest

from rowtide.contract import ForeignKey, TableContract
from rowtide.operators.related import apply_related

DDL = "seq long, action string, data map<string,string>, restriction map<string,string>"
PARENT = TableContract(name="users", columns=(("id", "bigint"), ("v", "string")), primary_key=("id",))
CHILD = TableContract(name="friends", columns=(("a", "bigint"), ("b", "bigint"), ("p", "bigint")), primary_key=("a", "b"))


def replay(parents, children, log, column):
    p, c, out = dict(parents), {(a, b): [a, b, x] for a, b, x in children}, {}
    at = {"a": 0, "p": 2}[column]
    for seq, side, action, data, restr in sorted(log, key=lambda x: x[0]):
        data, restr = {k: int(v) if v is not None and k != "v" else v for k, v in (data or {}).items()}, {k: int(v) for k, v in (restr or {}).items()}
        if side == "parent":
            k = data["id"] if action in ("add", "set") else restr["id"]
            if action in ("add", "set"):
                out[seq] = "inserted" if k not in p else "rejected" if action == "add" else "updated"
                p.setdefault(k, data.get("v"))
            elif k not in p:
                out[seq] = "noop"
            elif action == "delete":
                if any(r[at] == k for r in c.values()):
                    out[seq] = "quarantined"
                else:
                    del p[k]
                    out[seq] = "deleted"
            elif data["id"] in p:
                out[seq] = "quarantined"
            else:
                p[data["id"]] = p.pop(k)
                for r in c.values():
                    r[at] = data["id"] if r[at] == k else r[at]
                c = {(r[0], r[1]): r for r in c.values()}
                out[seq] = "updated"
        else:
            name = "abp"[at]
            bad = data.get(name) is not None and data[name] not in p
            if action == "add":
                k = (data["a"], data["b"])
                out[seq] = "rejected" if bad or k in c else "inserted"
                if out[seq] == "inserted":
                    c[k] = [data["a"], data["b"], data.get("p")]
            elif action == "delete":
                hit = [k for k, r in c.items() if all(r["abp".index(x)] == v for x, v in restr.items())]
                for k in hit:
                    del c[k]
                out[seq] = "deleted" if hit else "noop"
            else:
                r = c.get((restr["a"], restr["b"]))
                out[seq] = "noop" if r is None else "quarantined" if bad else "updated"
                if r is not None and not bad:
                    r[2] = data["p"]
    return sorted(p.items()), sorted(map(tuple, c.values()), key=str), out


@pytest.mark.parametrize("column", ["p", "a"])
def test_two_tables_in_one_log(spark, column):
    rng = random.Random(5)
    parents, children = [(i, "v") for i in range(1, 6)], [(1, 1, 2), (2, 1, None), (3, 1, 3)]
    k, log = (lambda: str(rng.randint(1, 7))), []
    for seq in range(1, 25):
        kind = rng.choice(["add", "del", "del", "move", "child", "child", "child_del", "child_drop", *(["child_upd"] if column == "p" else [])])
        log.append({
            "add": (seq, "parent", rng.choice(["add", "set"]), {"id": k()}, None),
            "del": (seq, "parent", "delete", None, {"id": k()}),
            "move": (seq, "parent", "update", {"id": k()}, {"id": k()}),
            "child": (seq, "child", "add", {"a": k(), "b": k(), "p": rng.choice([None, k()])}, None),
            "child_upd": (seq, "child", "update", {"p": k()}, {"a": k(), "b": k()}),
            "child_del": (seq, "child", "delete", None, {"a": k(), "b": k()}),
            "child_drop": (seq, "child", "delete", None, {"p": k()}),
        }[kind])
    log = [x for x in log if not (x[1] == "parent" and x[2] == "update" and x[3]["id"] == x[4]["id"])]
    side = lambda name: spark.createDataFrame([(s, a, d, r) for s, t, a, d, r in log if t == name], DDL)
    res = apply_related(spark.createDataFrame(parents, PARENT.schema), spark.createDataFrame(children, CHILD.schema), side("parent"), side("child"), PARENT, CHILD, ForeignKey((column,), ("id",)))
    want = replay(parents, children, log, column)
    out = {r.seq: r.outcome for r in [*res.parent.outcomes.collect(), *res.child.outcomes.collect()]}
    assert out == want[2]
    assert sorted((r.id, r.v) for r in res.parent.table.collect()) == [(i, v) for i, v in want[0]]
    assert sorted((tuple(r) for r in res.child.table.collect()), key=str) == want[1]
