"""Members and their classes are fitted by pools within pools, but only a few at once."""

import threading
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from toolpulse.operators import models as MM
from toolpulse.operators.experiments import EXPERIMENTS


class Classifier:
    lock, now, most, fitted = threading.Lock(), 0, 0, 0

    def setFeaturesCol(self, name):
        return self

    setLabelCol = setWeightCol = setFeaturesCol

    def fit(self, frame):
        with self.lock:
            Classifier.now += 1
            Classifier.most = max(Classifier.most, Classifier.now)
        time.sleep(0.2)
        with self.lock:
            Classifier.now -= 1
            Classifier.fitted += 1
        return self


def test_few_fits_at_once(spark):
    rows = spark.createDataFrame([(float(c % 5), c) for c in range(10)], "label double, fold int")
    experiment = replace(EXPERIMENTS["svm_multiclass"], build=lambda params, total: Classifier())
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda f: MM.fit_member(experiment, {}, rows), range(3)))
    assert Classifier.fitted == 15 and Classifier.most <= MM.PARALLEL_FITS
