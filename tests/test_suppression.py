"""Suppression and clusters: literal cases, and large groups against brute force."""

import random

import pytest

from boxloom.operators import clusters, overlap
from boxloom.operators import suppression as S

SCHEMA = "im_id int, pos long, name string, x1 double, y1 double, x2 double, y2 double, score double, source string"


def frame(spark, boxes):
    rows = [
        (b.get("im", 1), i + 1, b["name"], *[float(v) for v in b["box"]], float(b.get("score", 1.0)), b.get("source", "m"))
        for i, b in enumerate(boxes)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def kept(df):
    return sorted(r["pos"] for r in df.collect())


def iou(a, b):
    i = max(0.0, min(a[2], b[2]) - max(a[0], b[0])) * max(0.0, min(a[3], b[3]) - max(a[1], b[1]))
    if i == 0:
        return 0.0, 0.0
    aa, ab = (a[2] - a[0]) * (a[3] - a[1]), (b[2] - b[0]) * (b[3] - b[1])
    return i / (aa + ab - i), i / min(aa, ab)


def test_source_policy_merges_sources(spark):
    df = frame(
        spark,
        [
            {"name": "scarf", "box": [12, 40, 92, 100], "score": 0.95, "source": "fashion_model"},
            {"name": "scarf", "box": [20, 44, 95, 103], "score": 0.3, "source": "locate_anything"},
            {"name": "scarf", "box": [18, 41, 90, 99], "score": 0.6, "source": "original"},
            {"name": "scarf", "box": [300, 40, 380, 100], "score": 0.2, "source": "fashion_model"},
        ],
    )
    rows = S.suppress_by_policy(df, {"general": S.Policy(0.6, 0.8, "keep locate anything box")}).collect()
    assert sorted((r["pos"], r["source"]) for r in rows) == [(2, "locate_anything, fashion_model, original"), (4, "fashion_model")]


def test_enclosing_policy(spark):
    policy = {"general": S.Policy(0.45, 0.8, "keep smaller_if_encloses_multiple")}
    shoes = [[200, 310, 260, 350], [270, 312, 331, 349], [195, 300, 340, 360]]
    many = frame(spark, [{"name": "shoe", "box": b} for b in shoes])
    assert kept(S.suppress_by_policy(many, policy)) == [1, 2]
    single = frame(spark, [{"name": "shoe", "box": b} for b in (shoes[0], shoes[2])])
    assert kept(S.suppress_by_policy(single, policy)) == [2]


def test_priority_class(spark):
    df = frame(
        spark,
        [
            {"name": "watch", "box": [400, 20, 440, 60]},
            {"name": "Jewelry Product", "box": [100, 200, 180, 300]},
            {"name": "Other", "box": [600, 600, 640, 640]},
            {"name": "anklet", "box": [102, 202, 181, 299]},
            {"name": "jewelry_product", "box": [105, 205, 181, 299]},
            {"name": "anklet", "box": [174, 290, 260, 380]},
        ],
    )
    assert kept(S.clean_before_suppression(df)) == [1, 2, 5, 6]


def test_caps(spark):
    df = frame(spark, [{"name": n, "box": [i, i, i + 5, i + 5], "score": i / 20} for n in ("top", "bottom") for i in range(15)])
    out = S.cap_boxes(df, 4, 10).collect()
    assert len(out) == 8
    assert S.cap_boxes(df, 6, 10).count() == 10
    assert S.detection_limit(df, multiple=True, limit=-1).count() == 30
    assert S.detection_limit(df, multiple=False, limit=5).count() == 1


def test_empty_boxes_survive(spark):
    df = frame(spark, [{"name": "a", "box": [5, 5, 5, 5]}, {"name": "a", "box": [5, 5, 5, 5]}])
    assert kept(S.suppress_by_policy(df, {"general": S.Policy()})) == [1, 2]


def crowd(n, seed, span=60):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        x, y, w, h = rng.randint(0, span), rng.randint(0, span), rng.randint(0, 25), rng.randint(1, 25)
        out.append(
            {
                "name": rng.choice(["ring", "earring"]), "box": [x, y, x + w, y + h], "score": rng.randint(0, 9) / 10,
                "source": rng.choice(["locate_anything", "fashion_model", "original"]), "im": 1 if rng.random() < 0.7 else rng.randint(2, 9),
            }
        )
    return out


def brute_greedy(boxes, key, hit, group):
    """Plain walk, for comparison."""
    result = {}
    groups = {}
    for i, b in enumerate(boxes):
        groups.setdefault(group(b), []).append((i + 1, b))
    for members in groups.values():
        accepted = []
        for pos, b in sorted(members, key=lambda m: (*key(m, members), m[0])):
            for a in accepted:
                if hit(boxes[a - 1]["box"], b["box"]):
                    labels = result[a]
                    if b["source"] not in labels:
                        labels.append(b["source"])
                    break
            else:
                accepted.append(pos)
                result[pos] = [b["source"]]
    return {p: ", ".join(s) for p, s in result.items()}


def size(b):
    return max(0.0, (b["box"][2] - b["box"][0]) * (b["box"][3] - b["box"][1]))


KEYS = {
    "keep biggest": lambda m, _: (-size(m[1]), -m[1]["score"]),
    "keep smallest": lambda m, _: (size(m[1]), -m[1]["score"]),
    "keep fashion model box": lambda m, _: (m[1]["source"] != "fashion_model", -m[1]["score"]),
    "keep_smaller_if_encloses_multiple": lambda m, ms: (
        sum(1 for p, o in ms if size(o) < size(m[1]) and (iou(o["box"], m[1]["box"])[0] >= 0.4 or iou(o["box"], m[1]["box"])[1] >= 0.7)) >= 2,
        -size(m[1]),
    ),
}


@pytest.mark.parametrize("keep", list(KEYS))
@pytest.mark.parametrize("limit", [1024, 25])
def test_large_groups_match_brute_force(spark, keep, limit):
    boxes = crowd(160, 5)
    policy = {"general": S.Policy(0.4, 0.7, keep)}
    out = S.suppress_by_policy(frame(spark, boxes), policy, limit=limit).collect()
    expected = brute_greedy(
        boxes, KEYS[keep], lambda a, b: iou(a, b)[0] >= 0.4 or iou(a, b)[1] >= 0.7, lambda b: (b["im"], b["name"])
    )
    assert {r["pos"]: r["source"] for r in out} == expected


@pytest.mark.parametrize("limit", [1024, 20])
def test_order_free_suppression(spark, limit):
    boxes = crowd(200, 9)
    df = frame(spark, boxes)
    got = kept(S.suppress_across_classes(df, {"ring": ["earring", "ring"]}, 0.3, limit=limit))
    expected = [
        j + 1
        for j, b in enumerate(boxes)
        if not any(i != j and a["im"] == b["im"] and a["name"] == "ring" and iou(a["box"], b["box"])[0] >= 0.3 for i, a in enumerate(boxes))
    ]
    assert got == expected


def brute_clusters(boxes, threshold):
    parent = list(range(len(boxes)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(boxes):
        for j in range(i):
            if boxes[j]["im"] == a["im"] and iou(a["box"], boxes[j]["box"])[0] >= threshold:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    out = {}
    for im in {b["im"] for b in boxes}:
        roots = sorted({find(i) for i, b in enumerate(boxes) if b["im"] == im})
        for i, b in enumerate(boxes):
            if b["im"] == im:
                out[i + 1] = roots.index(find(i))
    return out


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.9, 1.0])
@pytest.mark.parametrize("limit", [1024, 20])
def test_clusters_match_brute_force(spark, threshold, limit):
    boxes = crowd(150, 3, span=40)
    out = clusters.overlap_clusters(frame(spark, boxes), threshold, limit=limit).collect()
    assert {r["pos"]: r["cluster_id"] for r in out} == brute_clusters(boxes, threshold)


def test_near_duplicates_form_one_cluster(spark):
    """Many almost equal boxes: contracted before any pair is looked at."""
    boxes = [{"name": "a", "box": [100 + i % 3, 100, 200 + i % 2, 200]} for i in range(300)]
    out = clusters.overlap_clusters(frame(spark, boxes), 0.5, limit=50)
    assert {r["cluster_id"] for r in out.collect()} == {0}
    summary = clusters.cluster_summary(out).collect()
    assert [(r["cluster_size"], r["top_pos"], r["second_score"]) for r in summary] == [(300, 1, 1.0)]


def test_cluster_summary_of_single_box(spark):
    df = frame(spark, [{"name": "a", "box": [0, 0, 10, 10], "score": 0.4}])
    row = clusters.cluster_summary(clusters.overlap_clusters(df, 0.5)).first()
    assert (row["second_score"], row["margin"], row["uncertainty"]) == (0.0, 0.4, 0.6)


@pytest.mark.parametrize("share", [0.0, 2.0])
def test_rounds_and_conflicts_agree(spark, monkeypatch, share):
    """Only local winners, or conflicts from the second round on."""
    monkeypatch.setattr(S, "WORTHWHILE", share)
    boxes = crowd(150, 12)
    out = S.suppress_by_policy(frame(spark, boxes), {"general": S.Policy(0.3, 0.6, "keep smallest")}, limit=10).collect()
    expected = brute_greedy(
        boxes, KEYS["keep smallest"], lambda a, b: iou(a, b)[0] >= 0.3 or iou(a, b)[1] >= 0.6, lambda b: (b["im"], b["name"])
    )
    assert {r["pos"]: r["source"] for r in out} == expected


def test_inclusive_form_in_large_groups(spark):
    """Boxes that only touch still overlap when edge pixels count."""
    boxes = crowd(120, 21) + [{"name": "ring", "box": [200, 200, 200, 200], "score": 0.9, "source": "a"}, {"name": "ring", "box": [200.4, 200, 200.4, 200], "score": 0.8, "source": "a"}]
    df = frame(spark, boxes)
    assert kept(S.suppress_inclusive(df, 0.4, limit=10)) == kept(S.suppress_inclusive(df, 0.4))
    assert 122 not in kept(S.suppress_inclusive(df, 0.4, limit=1))
    assert kept(S.suppress_ground_truth(df, 0.4, limit=10)) == kept(S.suppress_ground_truth(df, 0.4))
    assert kept(S.suppress_same_class(df, {"ring": "x"}, 0.4, limit=10)) == kept(S.suppress_same_class(df, {"ring": "x"}, 0.4))
    assert kept(S.suppress_smallest_first(df, limit=10)) == kept(S.suppress_smallest_first(df))


@pytest.mark.parametrize("limit", [1024, 15])
def test_priority_class_in_large_images(spark, limit):
    boxes = crowd(150, 33)
    for i, b in enumerate(boxes):
        b["name"] = "jewelry product" if i % 4 == 0 else b["name"]
    expected = [
        i + 1
        for i, b in enumerate(boxes)
        if b["name"] == "jewelry product"
        or not any(a["name"] == "jewelry product" and a["im"] == b["im"] and iou(a["box"], b["box"])[0] > 0.2 for a in boxes)
    ]
    assert kept(S.clean_before_suppression(frame(spark, boxes), 0.2, limit=limit)) == expected


@pytest.mark.parametrize("threshold", [0.0, -1.0])
@pytest.mark.parametrize("limit", [1024, 5])
def test_thresholds_that_every_pair_reaches(spark, threshold, limit):
    """Boxes far apart hit each other too, in small and in large groups."""
    boxes = crowd(60, 17, span=4000)
    df = frame(spark, boxes)
    for keep, key in KEYS.items():
        if keep == "keep_smaller_if_encloses_multiple":
            key = lambda m, ms: (sum(size(o) < size(m[1]) for _, o in ms) >= 2, -size(m[1]))
        out = S.suppress_by_policy(df, {"general": S.Policy(threshold, 0.7, keep)}, limit=limit).collect()
        assert {r["pos"]: r["source"] for r in out} == brute_greedy(boxes, key, lambda a, b: True, lambda b: (b["im"], b["name"]))
    one_each = len({(b["im"], b["name"]) for b in boxes})
    assert len(kept(S.suppress_ground_truth(df, threshold, limit=limit))) == one_each
    assert len(kept(S.suppress_smallest_first(df, threshold, 0.7, limit=limit))) == one_each
    inclusive = kept(S.suppress_inclusive(df, threshold, limit=limit))
    assert (len(inclusive) == one_each) if threshold < 0 else inclusive == kept(S.suppress_inclusive(df, threshold))
    out = clusters.overlap_clusters(df, threshold, limit=limit).collect()
    assert {r["pos"]: r["cluster_id"] for r in out} == brute_clusters(boxes, threshold)
    expected = [
        j + 1
        for j, b in enumerate(boxes)
        if not any(i != j and a["im"] == b["im"] and a["name"] == "ring" and b["name"] in ("earring", "ring") for i, a in enumerate(boxes))
    ]
    assert kept(S.suppress_across_classes(df, {"ring": ["earring", "ring"]}, threshold, limit=limit)) == expected


@pytest.mark.parametrize("keep", ["keep biggest", "keep_smaller_if_encloses_multiple"])
def test_crowded_cells_match_brute_force(spark, monkeypatch, keep):
    """Cells cut into blocks of a few boxes, conflicts listed from the second round on."""
    monkeypatch.setattr(overlap, "CELL_ROWS", 8)
    monkeypatch.setattr(S, "WORTHWHILE", 2.0)
    boxes = crowd(150, 41, span=30)
    out = S.suppress_by_policy(frame(spark, boxes), {"general": S.Policy(0.4, 0.7, keep)}, limit=10).collect()
    expected = brute_greedy(
        boxes, KEYS[keep], lambda a, b: iou(a, b)[0] >= 0.4 or iou(a, b)[1] >= 0.7, lambda b: (b["im"], b["name"])
    )
    assert {r["pos"]: r["source"] for r in out} == expected


def test_crowded_cells_of_clusters_and_other_classes(spark, monkeypatch):
    monkeypatch.setattr(overlap, "CELL_ROWS", 8)
    boxes = crowd(120, 43, span=30)
    out = clusters.overlap_clusters(frame(spark, boxes), 0.5, limit=10).collect()
    assert {r["pos"]: r["cluster_id"] for r in out} == brute_clusters(boxes, 0.5)
    df = frame(spark, boxes)
    classes = {"ring": ["earring", "ring"]}
    assert kept(S.suppress_across_classes(df, classes, 0.3, limit=10)) == kept(S.suppress_across_classes(df, classes, 0.3))


def test_one_crowded_spot_beside_huge_boxes(spark):
    """3,000 boxes on one spot and a few of a thousand times their size: cells follow the boxes in them."""
    rng = random.Random(7)
    boxes = [{"name": "ring", "box": [x := rng.randint(0, 40), y := rng.randint(0, 40), x + rng.randint(15, 25), y + rng.randint(15, 25)], "source": "m"} for _ in range(3000)]
    boxes += [{"name": "ring", "box": [0, 5000 * i, 40000, 5000 * i + 4000], "source": "m"} for i in range(1, 4)]
    cells = overlap.gridded(frame(spark, boxes), ["im_id"]).filter("native and x2 < 100")
    assert cells.groupBy("pos").count().agg({"count": "max"}).first()[0] <= 9 and {r["cell"] for r in cells.select("cell").distinct().collect()} <= {16.0, 32.0}
    got = kept(S.suppress_by_policy(frame(spark, boxes), {"general": S.Policy()}))
    kept_boxes, expected = [], []
    for pos, b in sorted(enumerate(boxes, 1), key=lambda m: (-size(m[1]), m[0])):
        if not any(max(iou(k, b["box"])) >= 0.7 for k in kept_boxes):
            kept_boxes.append(b["box"])
            expected.append(pos)
    assert got == sorted(expected)


def test_folds_do_not_carry_rows_through_lambdas(spark):
    """Lambdas copy their results at each level: only numbers come out of the walks, and results stay the same."""
    rows = [(1, 0, "ring", 0.0, 0.0, 10.0, 10.0, 0.5, "a"), (1, 1, "ring", 1.0, 0.0, 10.0, 10.0, 0.9, "b"), (1, 2, "ring", 50.0, 0.0, 60.0, 9.0, 0.9, "c"),
            (2, 7, "ring", 0.0, 0.0, 0.0, 9.0, 0.1, "x, x")]
    df = spark.createDataFrame(rows, "im_id long, pos long, name string, x1 double, y1 double, x2 double, y2 double, score double, source string")
    out = clusters.overlap_clusters(df, 0.5)
    assert sorted((r["im_id"], r["pos"], r["cluster_id"], r["cluster_size"]) for r in out.collect()) == [(1, 0, 0, 2), (1, 1, 0, 2), (1, 2, 1, 1), (2, 7, 0, 1)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.split("\n") if "aggregate(" in line and ".row, " in line.split("aggregate(")[1]]
    kept = S.suppress_by_policy(df, {"general": S.Policy()})
    assert sorted((r["im_id"], r["pos"], r["source"]) for r in kept.collect()) == [(1, 0, "a, b"), (1, 2, "c"), (2, 7, "x")]
    assert "named_struct(row, lambda" not in kept._jdf.queryExecution().optimizedPlan().toString()
