import random
import zlib

import numpy as np

from recspark.llm import toxicity


def test_no_informative_word_is_dropped(spark):
    seen = {}
    for i in range(10 ** 6):  # two words on the same place of a table of 2^20
        low = zlib.crc32(b"q%d" % i) & 0xFFFFF
        if low in seen:
            pair = [f"q{seen[low]}", f"q{i}"]
            break
        seen[low] = i
    rnd, rows, labels = random.Random(1), [], []
    for d in range(600):
        toxic = d % 2
        words = [rnd.choice("abcdefghijklmnop") * 3 for _ in range(20)]
        if toxic:
            words[5], words[15] = pair
        rows.append((d, " ".join(words)))
        labels.append((d, 1, toxic))
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"),
                         spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    h = np.array([zlib.crc32(w.encode()) for w in [*pair, "never"]], np.uint64)
    ratio = model.ratio(h)
    assert ratio[0] > 1 and ratio[1] > 1 and ratio[2] == 0
