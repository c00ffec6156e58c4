"""Places of the subpackage that bring rows to the driver, and what bounds them."""

import pathlib

import cardwatch.llm

BOUNDED = {
    ("exact_topk.py", "toArrow"): (2, "a block of 4,096 queries; seed rows"),
    ("forest_search.py", "toArrow"): (1, "the sample that the trees are cut from"),
    ("forest_search.py", ".collect()"): (1, "one row per leaf, a fixed number"),
    ("mixing.py", ".collect()"): (1, "one row per block of sources, 4,096 at most"),
    ("ngram_join.py", "toArrow"): (1, "200,000 frequent n-grams"),
    ("packing.py", ".collect()"): (1, "one row per length of a piece, 70 at most"),
    ("personal_data.py", ".collect()"): (1, "1,500 sample windows of 96 characters"),
    ("quality.py", "toLocalIterator"): (1, "8,000 labelled rows"),
    ("sharding.py", ".collect()"): (2, "block sums; groups above the block limit"),
    ("toxicity.py", "toLocalIterator"): (1, "4,000 labelled rows per label"),
}
WORDS = ("localCheckpoint", "toPandas", ".collect()", "crossJoin", "toLocalIterator", "toArrow", ".rdd")


def test_only_bounded_results_reach_the_driver():
    found = {}
    for path in pathlib.Path(cardwatch.llm.__file__).parent.glob("*.py"):
        found |= {(path.name, w): n for w in WORDS if (n := path.read_text().count(w))}
    assert found == {place: n for place, (n, _) in BOUNDED.items()}
