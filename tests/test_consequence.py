"""Layers of pipes with links, costs and crossing rows listed more than once, against rows spelled out."""

import re

from mainstay.operators import consequence as K
from mainstay.params import ConsequenceCosts

COSTS = ConsequenceCosts()
LINKS = [(1, 10, 4.0), (1, 10, 4.0), (1, 20, 6.0), (2, 10, None), (3, 30, 2.0), (4, None, 5.0), (None, 40, 9.0), (5, 50, 0.0)]
PRICES = [(1, 100.0), (1, 7.0), (2, None), (3, 50.0), (4, 11.0), (5, 3.0), (9, 1.0)]
KINDS = [(1, "S"), (1, "s"), (3, "C"), (4, "S")]
CROSSED = [(1, 1, 0, 2, 1, 1110), (1, 0, 0, 0, 0, 1500), (3, 0, 1, 0, None, 1400), (4, 2, 0, 0, 0, 1300), (2, 2, 0, 0, 0, None)]


def _tables(spark):
    names = "mlinkid long, xschl int, xhosp int, xpol int, xfire int, pstrttyp int"
    return (
        spark.createDataFrame([(*r, None, None) for r in LINKS], "mlinkid long, compkey long, length double, usnode long, dsnode long"),
        spark.createDataFrame(PRICES, "mlinkid long, totalconstructioncost double"),
        spark.createDataFrame(KINDS, "mlinkid long, type string"), spark.createDataFrame(CROSSED, names),
        spark.createDataFrame([(1110, "Frwy"), (1300, "MjrArt"), (1400, "Art"), (1500, "Strt")], "street_number int, street_grp string"),
    )


def _rows(df):
    key = lambda r: tuple((v is None, str(v)) for v in r)
    return sorted((tuple(r) for r in df.select("compkey", "consequence", "sfm", "tblf", "reason").collect()), key=key)


def test_totals_spell_out_the_pairs(spark):
    links = _tables(spark)[0]
    want = {}
    for m, pipe, _ in LINKS:
        for other, _, length in LINKS:
            if m is not None and m == other:
                known, count = want.get(pipe, (None, 0))
                want[pipe] = (known if length is None else (known or 0.0) + length, count + 1)
    got = {r.compkey: (r.sum_length, r.links) for r in K.trace_totals(links).collect()}
    assert got == want


def test_mortality_is_the_union_of_its_layers(spark):
    links, prices, kinds, xp, streets = _tables(spark)
    single = [
        K.emergency_repair(links, prices, COSTS), K.separated_area_fine(links, kinds, COSTS), K.basement_flooding(links, COSTS),
    ]
    health = K.all_health_safety(links, xp, streets, COSTS)
    rest = [
        K.replacement_cost(links, prices, xp), K.emergency_lateral_repair(links, COSTS), K.lateral_flooding(links, COSTS),
        K.lateral_flooding_health(links, COSTS),
    ]
    whole = K.all_mortality(links, prices, kinds, xp, streets, COSTS)
    every = K.all_mortality_components(links, prices, kinds, xp, streets, COSTS)

    def united(parts):
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return _rows(out.distinct())

    assert _rows(whole) == united([*single, K.health_safety(links, xp, streets, COSTS)])
    assert _rows(every) == united([*single, *rest, health])


def test_links_are_read_once_for_all_layers_without_crossings(spark, tmp_path):
    tables = _tables(spark)
    stored = []
    for i, t in enumerate(tables):
        t.write.parquet(f"{tmp_path}/{i}")
        stored.append(spark.read.parquet(f"{tmp_path}/{i}"))
    plan = K.all_mortality(*stored, COSTS)._jdf.queryExecution().optimizedPlan().toString()
    # Links for the layers by pipe and for health and safety; prices and kinds once.
    assert len(re.findall(r"Relation \[", plan)) <= 6
