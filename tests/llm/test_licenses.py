import re

from tests_llm_helpers import edge_rows, got, make, package  # noqa: F401
from tessera.llm import licenses as li


def plain(text, templates, t):
    """Every block against every template, no pruning."""
    def ws(x):
        return [w for w in re.split(r"[^a-z0-9.+\x80-\U0010FFFF]+", x.lower()) if w]
    lines = [ws(x) for x in (text or "").split("\n")]
    blocks = [x for x in lines if x]
    if len(blocks) > 1:
        blocks.append([w for b in blocks for w in b])
    best, names, n = None, set(), 0
    for b in blocks:
        g = {f"{x} {y}" for x, y in zip(b, b[1:])}
        hits = []
        for name, body in templates.items():
            m = set(li.template_bigrams(body))
            s = 2 * len(g & m) / (len(g) + len(m))
            if s >= t:
                hits.append((-s, name))
        n += bool(hits)
        names |= {h[1] for h in hits}
        best = min([*( [best] if best else []), *hits], default=None)
    return (len(blocks), n, best[1] if best else None, -best[0] if best else None, ",".join(sorted(names)))


def test_matches_plain_compare(make):
    rows = edge_rows() + [(20 + k, f"Some words first.\n{v}\nand after it", "en", "s", 1) for k, v in enumerate(li.TEMPLATES.values())]
    rows += [(60, li.TEMPLATES["MIT-text"].upper().replace(",", " ;; "), "en", "s", 1), (61, li.TEMPLATES["ISC"].replace("purpose", "aim"), "en", "s", 1),
             (62, "Released under the MIT License. Released under the MIT License.", "en", "s", 1), (63, "GNU General Public License", "en", "s", 1)]
    res = got(li.scan(make(rows)))
    assert len(res) == len(rows)
    want = sorted([(r[0], *plain(r[1], li.TEMPLATES, li.THRESHOLD)) for r in rows], key=str)
    assert sorted([tuple(r.values()) for r in res], key=str) == want
    assert got(li.scan(make([]))) == []


def test_native_plan(make):
    plan = li.scan(make(edge_rows()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
