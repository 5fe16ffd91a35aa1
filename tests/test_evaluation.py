import pytest

from pagedater.operators import evaluation

LABELS = list(evaluation.CONFUSION_LABELS)

# The published confusion matrix of the support vector machine
# (rows are true classes), and the averages printed for it.
PUBLISHED = {
    1450: [0, 0, 0, 0, 0, 0, 0, 0, 1, 0, 0, 0],
    1500: [0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0],
    1550: [0, 0, 0, 0, 0, 0, 0, 0, 2, 0, 0, 0],
    1600: [0, 0, 0, 0, 0, 0, 4, 0, 7, 0, 0, 0],
    1650: [0, 0, 0, 0, 0, 0, 7, 0, 8, 1, 0, 0],
    1700: [0, 0, 0, 0, 0, 0, 6, 0, 9, 0, 0, 0],
    1750: [0, 0, 0, 0, 0, 0, 53, 0, 41, 1, 0, 0],
    1800: [0, 0, 0, 0, 0, 0, 0, 8, 285, 5, 0, 0],
    1850: [0, 0, 0, 0, 0, 0, 6, 0, 841, 54, 0, 0],
    1900: [0, 0, 0, 0, 0, 0, 0, 1, 485, 130, 0, 0],
    1950: [0, 0, 0, 0, 0, 0, 0, 0, 24, 12, 0, 0],
    2000: [0, 0, 0, 0, 0, 0, 0, 0, 7, 2, 0, 0],
}
PRINTED = {
    "accuracy": 0.52,
    "weighted avg": (0.58, 0.52, 0.42),
    "macro avg": (0.25, 0.16, 0.15),
}
ROUNDING = 0.006


@pytest.fixture(scope="module")
def published(spark):
    rows = [
        (label, prediction)
        for label, counts in PUBLISHED.items()
        for prediction, n in zip(LABELS, counts)
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, "label int, prediction int")


def frame(spark, rows):
    return spark.createDataFrame(rows, "label int, prediction int")


def test_published_figures(published):
    assert evaluation.accuracy(published).first()[0] == pytest.approx(PRINTED["accuracy"], abs=ROUNDING)
    report = {r["class"]: (r.precision, r.recall, r.f1) for r in evaluation.class_report(published).collect()}
    for name in ("weighted avg", "macro avg"):
        assert report[name] == pytest.approx(PRINTED[name], abs=ROUNDING)


def test_published_matrix_comes_back(published):
    got = {r["label"]: [r[str(c)] for c in LABELS] for r in evaluation.confusion(published).collect()}
    assert got == PUBLISHED


def test_labels_outside_the_list_are_not_counted(spark):
    df = frame(spark, [(1300, 1850), (1850, 1300), (1850, 1850), (None, 1850)])
    total = sum(sum(r[str(c)] for c in LABELS) for r in evaluation.confusion(df).collect())
    assert total == 1


def test_class_report(spark):
    df = frame(spark, [(1, 1), (1, 1), (1, 2), (2, 1), (3, 1), (2, 4)])
    report = {r["class"]: tuple(r)[1:] for r in evaluation.class_report(df).collect()}
    assert report["1"] == pytest.approx((0.5, 2 / 3, 4 / 7, 3))
    assert report["2"] == (0.0, 0.0, 0.0, 2)
    assert report["3"] == (0.0, 0.0, 0.0, 1), "never predicted"
    assert report["4"] == (0.0, 0.0, 0.0, 0), "never true"
    assert report["macro avg"] == pytest.approx((0.125, 1 / 6, 1 / 7, 6))
    assert report["weighted avg"] == pytest.approx((0.25, 1 / 3, 2 / 7, 6))


def test_report_of_text_labels(spark):
    df = spark.createDataFrame([("fr", "fr"), ("fr", "en")], "label string, prediction string")
    report = {r["class"]: r.recall for r in evaluation.class_report(df).collect()}
    assert report["fr"] == 0.5
    assert [r["fr"] for r in evaluation.confusion(df, ["fr", "en"]).orderBy("label").collect()] == [0, 1]


def test_neighbour_error(spark):
    df = frame(spark, [(1900, 1900), (1900, 1850), (1900, 1950), (1900, 1800)])
    assert evaluation.neighbour_error(df).first()[0] == 0.75
