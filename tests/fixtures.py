"""Small synthetic fixtures shaped like the original jobs' inputs (see
FIXTURES.md section 2).  Values come from fixed formulas, not from the
original data files."""

from __future__ import annotations

import math

# The 14 recorded (label, prediction) pairs of the tuned flower forest
# (FIXTURES.md section 3): 3 x (0,0), 4 x (1,1), 6 x (2,2), 1 x (2,1).
IRIS_PAIRS = [(0.0, 0.0)] * 3 + [(1.0, 1.0)] * 4 + [(2.0, 2.0)] * 6 + [(2.0, 1.0)]


def flowers(spark):
    """id, f1..f4, species: 3 groups of 50 by a fixed formula."""
    rows = []
    centres = {"Iris-setosa": (5.0, 3.4, 1.5, 0.2),
               "Iris-versicolor": (5.9, 2.8, 4.3, 1.3),
               "Iris-virginica": (6.6, 3.0, 5.6, 2.0)}
    i = 0
    for species, c in centres.items():
        for k in range(50):
            wobble = [0.25 * math.sin(1.7 * k + j) for j in range(4)]
            rows.append((i, *[round(c[j] + wobble[j], 2) for j in range(4)], species))
            i += 1
    return spark.createDataFrame(
        rows, "id int, f1 double, f2 double, f3 double, f4 double, species string")


def cytology_csv(path):
    """A CSV with a quoted header, integers 1-10, '?' in c6, repeated ids."""
    lines = ['"id","c1","c2","c3","c4","c5","c6","c7","c8","c9","class"']
    for i in range(60):
        vals = [str(1 + (i * (j + 3)) % 10) for j in range(9)]
        if i % 11 == 4:
            vals[5] = "?"
        cls = "4" if sum(int(v) for v in vals if v != "?") > 50 else "2"
        lines.append(",".join([str(1000 + i % 45)] + vals + [cls]))
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return lines


MAIL = [
    (0.0, "Hello rileystl"),
    (0.0, ""),
    (0.0, "we are  having issue"),
    (0.0, "re your message\tclick"),
    (0.0, "Thankskat!"),
    (0.0, "don't call 0800 NOW"),
    (0.0, "Réunion à Genève"),
    (0.0, "Hello rileystl"),
    (1.0, "WIN a FREE prize, click now!!!"),
    (1.0, "cash prize waiting click link"),
    (1.0, "free free free offer"),
]


def mail(spark):
    return spark.createDataFrame(MAIL, "label double, text string")


def pairs_with_nulls(spark):
    rows = [(0.0, 0.0), (1.0, 0.0), (None, 1.0), (2.0, None), (1.0, 1.0), (0.0, 2.0)]
    return spark.createDataFrame(rows, "prediction double, label double")


def tied_scores(spark):
    rows = [(0.9, 1.0), (0.9, 0.0), (0.8, 1.0), (0.5, 1.0), (0.5, 0.0),
            (0.5, 0.0), (0.3, 0.0), (0.1, 1.0), (0.1, 0.0)]
    return spark.createDataFrame(rows, "score double, label double")
