"""What the driver holds while it fits the toxicity model."""

import random
import tracemalloc

from lexitrend.llm import op2_toxicity as TX


def test_toxicity_fit_holds_little_in_the_driver(spark):
    """8,000 rows by 1,100 words took over 140 MB as floats, and more as lists of words."""
    rng = random.Random(3)
    words = [f"w{k}" for k in range(2000)]
    rows = [(k, k % 2, " ".join(rng.choices(words, k=40) + (["bad"] if k % 2 else ["fine"]))) for k in range(8000)]
    sample = spark.createDataFrame(rows, "_id long, _label int, _text string").repartition(4).cache()
    sample.count()
    tracemalloc.start()
    model = TX.fit(sample)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    sample.unpersist()
    assert peak < 100e6
    scores = model(["w1 bad w2", "w1 fine w2"])
    assert scores[0] > 0.9 and scores[1] < 0.1
