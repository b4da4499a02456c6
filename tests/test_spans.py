"""Intervals and families against plain versions, over borders of blocks and levels of bins."""

import random

from varloom.operators import family, intervals


def rows(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.select(*names).collect())


def test_islands_over_borders(spark):
    rng = random.Random(5)
    loci = [(c, rng.randrange(0, 3000)) for c in "ABC" for _ in range(150)] + [("D", -5), ("D", 0), ("D", 4), ("E", 10**12)]
    for gap in (0, 3, 40, 5000):
        want = []
        for c in sorted({c for c, _ in loci}):
            run = []
            for p in sorted({p for x, p in loci if x == c}):
                if run and p - run[-1] > gap:
                    want.append((c, run[0], run[-1], len(run)))
                    run = []
                run.append(p)
            want.append((c, run[0], run[-1], len(run)))
        df = spark.createDataFrame(loci, "chrom string, pos long")
        for width in (7, 100, 1 << 20):
            assert rows(intervals.merge_regions(df, gap, width), "chrom", "start_pos", "end_pos", "loci") == sorted(want), (gap, width)


def test_merged_intervals_over_borders(spark):
    rng = random.Random(6)
    spans = [(c, s, s + rng.choice((0, 1, 5, 60, 400))) for c in "AB" for s in (rng.randrange(-50, 4000) for _ in range(60))] + [("C", 0, 99), ("C", 100, 200), ("C", 200, 205), ("D", 9, 3)]
    for pad in (0, 2):
        want = []
        for c in sorted({x[0] for x in spans}):
            now = None
            for s, e in sorted((s - pad, e + pad) for x, s, e in spans if x == c and s - pad <= e + pad):
                if now and s <= now[1]:
                    now[1] = max(now[1], e)
                else:
                    now and want.append((c, *now))
                    now = [s, e]
            now and want.append((c, *now))
        df = spark.createDataFrame(spans, "chrom string, start_pos long, end_pos long")
        for width in (10, 100, 1 << 20):
            assert rows(intervals.interval_merge(df, pad, width), "chrom", "start_pos", "end_pos") == sorted(want), (pad, width)


def test_points_meet_spans_of_any_length(spark):
    rng = random.Random(7)
    points = [("A", rng.randrange(0, 1 << 22), i) for i in range(300)] + [("A", 5, 300), ("A", 5, 301), ("B", 5, 302)]
    spans = [("A", s, s + n, f"{s}:{n}") for n in (0, 10, 1023, 1024, 9000, 70_000, 1 << 21) for s in (rng.randrange(0, 1 << 22) for _ in range(15))] + [("A", 0, 1 << 40, "all"), ("A", 9, 3, "none")]
    p = spark.createDataFrame(points, "chrom string, pos long, id int")
    s = spark.createDataFrame(spans, "chrom string, start_pos long, end_pos long, name string")
    for pad in (0, 8):
        want = sorted((i, n) for c, at, i in points for d, a, b, n in spans if c == d and a - pad <= b + pad and a - pad <= at <= b + pad)
        assert rows(intervals.span_join(p, s, pad), "id", "name") == want
        assert rows(intervals.inside(p, s.where("name <> 'all'"), pad), "id") == sorted({(i,) for i, n in want if n != "all"})


def test_order_over_the_genome(spark):
    rng = random.Random(8)
    data = [(c, rng.randrange(0, 500), f"k{i}") for i, c in enumerate(rng.choices(["1", "2", "10", "22", "X", "MT"], k=300))]
    ordered = sorted(data, key=lambda r: (not r[0].isdigit(), int(r[0]) if r[0].isdigit() else 0, r[0], r[1], r[2]))
    for width in (16, 1 << 20):
        found = intervals.genomic_rank(spark.createDataFrame(data, "chrom string, pos long, variant_key string"), width)
        assert rows(found, "nth", "variant_key") == [(i + 1, r[2]) for i, r in enumerate(ordered)]


CALLS = "case_id string, family_id string, relationship string, proband_status string, variant_key string, gene string, gt string, gq int, dp int"


def test_family_facts_from_one_table(spark):
    def call(case, key, gt, gene="G", gq=30, dp=30, fam="F"):
        return (case, fam, {"c": "child", "m": "mother", "f": "affected_father"}[case[-1]], "proband" if case[-1] == "c" else "relative", key, gene, gt, gq, dp)

    data = [
        call("c", "new", "0/1"), call("m", "new", "0/0"), call("f", "new", "0|0"), call("c", "unseen", "0/1"), call("m", "unseen", "0/0"),  # the father wasn't called
        call("c", "poor", "0/1"), call("m", "poor", "0/0", gq=5), call("f", "poor", "0/0"), call("c", "from", "0/1"), call("f", "from", "1/1"),
        call("c", "a1", "0/1"), call("f", "a1", "0/1"), call("c", "b2", "0|1"), call("m", "b2", "0/1"), call("c", "z3", "0/1", gene=None), call("m", "z3", "0/1", gene=None),
        call("c", "hom", "1/1"), call("f", "hom", "1|1"), call("m", "hom", "0/1"), call("2c", "new", "0/1", fam="F2"), call("2m", "new", "0/0", fam="F2"),
    ]
    calls = spark.createDataFrame(data, CALLS)
    pedigree = spark.createDataFrame([("F", "c", "m", "f"), ("F2", "2c", "2m", None)], "family_id string, proband_id string, mother_id string, father_id string")
    table = family.trios(calls, pedigree, ("affected_father",), ("proband",))
    assert rows(family.de_novo(table), "family_id", "proband_id", "variant_key", "gene") == [("F", "c", "new", "G")]
    assert rows(family.compound_het(table), "family_id", "gene", "variant_a", "variant_b") == [("F", "G", "a1", "b2")]  # from: also the father's, but after b2
    assert rows(family.shared_homozygous(table), "variant_key", "n_affected_hom") == [("hom", 2)]
    plan = family.de_novo(table)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 2 and plan.count("Aggregate") == 1
