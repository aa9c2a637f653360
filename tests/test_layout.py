"""Dilated components, merged ranges, absorbed boxes, numeric bodies and gaps against plain loops over a grid."""

import random

import pytest

from sparkloom.operators import grid as G


def _components(mask):
    left, out = set(mask), []
    for start in sorted(mask):
        if start in left:
            left.discard(start)
            stack, coords = [start], []
            while stack:
                r, c = stack.pop()
                coords.append((r, c))
                for n in ((r - 1, c), (r + 1, c), (r, c - 1), (r, c + 1)):
                    if n in left:
                        left.discard(n)
                        stack.append(n)
            out.append(coords)
    return out


def _box(coords):
    rows, cols = [r for r, _ in coords], [c for _, c in coords]
    return min(rows), max(rows), min(cols), max(cols)


def _inside(box, at):
    return box[0] <= at[0] <= box[1] and box[2] <= at[1] <= box[3]


def _layout(cells, merged, rows, cols):
    high, wide = max(r for r, _ in cells), max(c for _, c in cells)
    mask = {(y, x) for r, c in cells for y in range(max(1, r - rows), min(high, r + rows) + 1) for x in range(max(1, c - cols), min(wide, c + cols) + 1)}
    out = []
    for coords in _components(mask):
        r, c = min(coords)
        grown = set(coords)
        for m in merged:
            if any(_inside(m, at) for at in coords):
                grown |= {(m[0], m[2]), (m[1], m[3])}
        box = _box(grown)
        out.append((r * (1 << 20) + c, *_box([at for at in cells if _inside(box, at)])))
    return out


def _absorbed(boxes):
    kept = []
    for b in sorted(boxes, key=lambda b: (-(b[2] - b[1] + 1) * (b[4] - b[3] + 1), b[1], b[3], b[0])):
        for k, taken in kept:
            if k[1] <= b[1] and b[2] <= k[2] and k[3] <= b[3] and b[4] <= k[4]:
                taken.append(b[0])
                break
        else:
            kept.append((b, []))
    return {(k, tuple(t)) for k, t in kept}


@pytest.fixture(scope="module")
def grids():
    rng = random.Random(5)
    return {s: {(r, c): rng.choice(["1", "2.5", "word", "7%"]) for r in range(1, 30) for c in range(1, 24) if rng.random() < share} for s, share in enumerate((0.04, 0.1, 0.2, 0.45))}


@pytest.fixture(scope="module")
def merged(grids):
    rng = random.Random(6)
    return {s: [(r, r + rng.randint(0, 3), c, c + rng.randint(1, 6)) for r, c in ((rng.randint(1, 25), rng.randint(1, 16)) for _ in range(4))] for s in grids}


@pytest.fixture(scope="module")
def cells(spark, grids):
    return spark.createDataFrame([(s, r, c, v, v == "word" and r % 2 == 0) for s, g in grids.items() for (r, c), v in g.items()] + [(0, 3, 99, " ", True)], "sheet int, r int, c int, value string, bold boolean")


@pytest.mark.parametrize("rows,cols,with_merged", [(0, 1, True), (1, 1, False), (0, 0, True)])
def test_boxes_and_absorption_equal_loops(spark, grids, merged, cells, rows, cols, with_merged):
    m = spark.createDataFrame([(s, *x) for s, each in merged.items() for x in each], "sheet int, r1 int, r2 int, c1 int, c2 int")
    found = G.layout_boxes(cells, m if with_merged else None, rows, cols).select("sheet", "component", "r1", "r2", "c1", "c2")
    expected = {s: _layout(g, merged[s] if with_merged else [], rows, cols) for s, g in grids.items()}
    assert sorted(map(tuple, found.collect())) == sorted((s, *b) for s, each in expected.items() for b in each)
    out = G.absorbed(found).select("sheet", "component", "r1", "r2", "c1", "c2", "absorbed").collect()
    assert {(r[0], tuple(r[1:6]), tuple(r[6])) for r in out} == {(s, *k) for s, each in expected.items() for k in _absorbed(each)}
    assert rows or not with_merged or any(r.absorbed for r in out)


def test_equal_boxes_and_empty_sheets(spark, cells):
    same = spark.createDataFrame([("s", 5, 1, 4, 1, 4), ("s", 3, 1, 4, 1, 4), ("s", 9, 2, 3, 2, 3), ("t", 9, 2, 3, 2, 3)], "sheet string, component long, r1 int, r2 int, c1 int, c2 int")
    assert {(r.sheet, r.component, tuple(r.absorbed)) for r in G.absorbed(same).collect()} == {("s", 3, (5, 9)), ("t", 9, ())}
    none = cells.limit(0)
    assert G.absorbed(G.layout_boxes(none)).count() == G.numeric_bodies(none, same).filter("body_r1 is not null").count() == G.element_gaps(none, same.limit(0)).count() == 0


def test_numeric_bodies_equal_loops(spark, grids, cells):
    blocks = [(s, r, r + 9, c, c + 7) for s in grids for r in (1, 4, 12) for c in (1, 9, 15)] + [(0, 40, 41, 1, 2)]
    expected = set()
    for s, *b in blocks:
        part = {at: v for at, v in grids[s].items() if _inside(b, at)}
        found = [(len(x), *_box(x), min(x)) for x in _components({at for at, v in part.items() if v != "word"})]
        best = max(found, key=lambda f: (f[0], f[2] - f[1], f[4] - f[3], (-f[5][0], -f[5][1]))) if found else None
        title = any(v == "word" and at[0] == b[0] and at[0] % 2 == 0 for at, v in part.items())
        expected.add((s, *b, title, *((*best[1:5], best[0], best[1] - b[0], best[3] - b[2]) if best else (None,) * 7)))
    b = spark.createDataFrame(blocks, "sheet int, r1 int, r2 int, c1 int, c2 int")
    out = G.numeric_bodies(cells, b).select("sheet", "r1", "r2", "c1", "c2", "title_row", "body_r1", "body_r2", "body_c1", "body_c2", "body_cells", "title_gap", "left_margin")
    assert {tuple(r) for r in out.collect()} == expected


def test_gaps_equal_loops(spark, grids, cells):
    rng = random.Random(7)
    elements, expected = [], set()
    for s, g in grids.items():
        own = sorted({(r, c, r + rng.randint(0, 4), c + rng.randint(0, 5)) for r, c in ((rng.randint(1, 24), rng.randint(1, 18)) for _ in range(9))})
        elements += [(s, r1, r2, c1, c2) for r1, c1, r2, c2 in own]
        for i, (r1, c1, r2, c2) in enumerate(own):
            rows = cols = None
            if i:
                p1, q1, p2, q2 = own[i - 1]
                rows = cols = 0
                for r in range(p2 + 1, r1):
                    if any((r, c) in g for c in range(min(q1, c1), max(q2, c2) + 1)):
                        break
                    rows += 1
                for c in range(q2 + 1, c1):
                    if any((r, c) in g for r in range(min(p1, r1), max(p2, r2) + 1)):
                        break
                    cols += 1
            after = own[i + 1][:2] if i + 1 < len(own) else (None, None)
            expected.add((s, r1, c1, i + 1, *(own[i - 1][:2] if i else (None, None)), *after, rows, cols))
    e = spark.createDataFrame(elements, "sheet int, r1 int, r2 int, c1 int, c2 int")
    out = G.element_gaps(cells, e).select("sheet", "r1", "c1", "place", "before_r1", "before_c1", "after_r1", "after_c1", "gap_rows", "gap_cols")
    assert {tuple(r) for r in out.collect()} == expected and any(x[8] for x in expected) and any(x[9] for x in expected)


def _context(cells, merged):
    """Of each numeric cell: group, metric, axis label and value, by plain walks up its column."""
    number = lambda t: t.rstrip("%").replace(".", "").isdigit()
    spread = dict(cells)
    for r, c1, c2 in sorted(merged):
        if (r, c1) in cells and not number(cells[r, c1]):
            spread |= {(r, c): cells[r, c1] for c in range(c1 + 1, c2 + 1) if (r, c) not in cells}
    out = set()
    for (r, c), value in cells.items():
        if not number(value):
            continue
        above = [spread[y, c] for y in range(1, r) if (y, c) in spread and not number(spread[y, c])]
        group = metric = ""
        for text in above:
            if text.lower().startswith("fig. 2"):
                continue
            if "body weight" in text.lower():
                metric = text
            elif not group:
                group = text
        group = group or (above[-1] if above else "")
        lead = cells.get((r, 1), "")
        names = [cells[y, 1] for y in range(1, r) if (y, 1) in cells and not number(cells[y, 1])]
        label = ("row_label" if lead else "") if not lead or not number(lead) else (names[-1] if names else "")
        out.add((r, c, value, group, metric, label, lead))
    return out


def test_column_context_equals_plain_walks(spark):
    rng = random.Random(8)
    texts = ["1", "2.5", "7%", "30", "Fig. 2 title", "fig. 2", "Body weight (g)", "body weight", "mRNA", "PBS", "group 3"]
    sheets = {s: {(r, c): rng.choice(texts) for r in range(1, 25) for c in range(1, 12) if rng.random() < share} for s, share in enumerate((0.1, 0.3, 0.7))}
    merged = {s: [(r, c, c + rng.randint(0, 4)) for r in range(1, 25) for c in range(1, 12) if rng.random() < 0.1] for s in sheets}
    cells = spark.createDataFrame([(s, r, c, v) for s, g in sheets.items() for (r, c), v in g.items()] + [(0, 40, 1, " "), (0, 40, 2, None)], "sheet int, r int, c int, value string")
    ranges = spark.createDataFrame([(s, r, r, a, b) for s, m in merged.items() for r, a, b in m], "sheet int, r1 int, r2 int, c1 int, c2 int")
    for m, df in ((merged, ranges), ({s: [] for s in sheets}, None)):
        got = {tuple(x) for x in G.column_context(cells, df).collect()}
        assert got == {(s, *x) for s in sheets for x in _context(sheets[s], m[s])}
    assert G.column_context(cells.limit(0), ranges).count() == 0


def _plain_components(places):
    """(sheet, r, c) -> smallest place of its component, by a walk over the grid."""
    out = {}
    for start in sorted(places):
        todo = [start]
        while todo:
            at = todo.pop()
            if at in places and at not in out:
                out[at] = start[1] * (1 << 20) + start[2]
                s, r, c = at
                todo += [(s, r + 1, c), (s, r - 1, c), (s, r, c + 1), (s, r, c - 1)]
    return out


def test_components_within_and_across_bands(spark, monkeypatch):
    r = random.Random(3)
    places = {(s, y, x) for s in range(6) for y in range(1, 26) for x in range(1, 20) if r.random() < (0.45, 0.6, 0.75)[s % 3]}
    places |= {(9, y, 5 if y % 4 < 2 else 6) for y in range(1, 120)} | {(9, y, x) for y in range(2, 120, 2) for x in (5, 6)}  # one component over many bands
    cells = spark.createDataFrame([(*p, "v") for p in sorted(places)], "sheet int, r int, c int, value string")
    want = _plain_components(places)
    spread, rounds = G._spread, []
    monkeypatch.setattr(G, "_spread", lambda links: rounds.append(1) or spread(links))

    def found():
        runs = G.components(cells)
        assert dict(runs.dtypes) == {"sheet": "int", "r": "int", "c1": "int", "c2": "int", "component": "bigint"}
        return {(x.sheet, x.r, c): x.component for x in runs.collect() for c in range(x.c1, x.c2 + 1)}

    monkeypatch.setattr(G, "BAND", 1 << 10)
    assert found() == want and not rounds  # whole sheets in a band: no label goes through a round
    monkeypatch.setattr(G, "BAND", 4)
    assert found() == want and rounds
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert found() == want  # bands that go on in the next batch
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
