"""Source fall-back, dataset report, pipeline info."""

import pytest

from opinio.operators.profile import dataset_report
from opinio.operators.vocabulary import fit_vocabulary, label_encode, vocabulary_info
from opinio.options import FeatureOptions
from opinio.sources.reviews import load_reviews


def test_source_falls_back_to_label_directories(spark, tmp_path):
    for subset, name, n in (("train", "pos", 3), ("train", "neg", 2), ("test", "pos", 1)):
        (tmp_path / "corpus" / subset / name).mkdir(parents=True)
        for i in range(n):
            (tmp_path / "corpus" / subset / name / f"{i}.txt").write_text(f"text {subset} {i}\nline")
    got = load_reviews(spark, [str(tmp_path / "none.csv")], str(tmp_path / "corpus")).collect()
    assert sorted(r.sentiment for r in got) == [0, 0, 1, 1, 1, 1]
    (tmp_path / "some.csv").write_text("review,sentiment\nfine,positive\n")
    assert load_reviews(spark, [str(tmp_path / "none.csv"), str(tmp_path / "some.csv")], str(tmp_path / "corpus")).count() == 1
    with pytest.raises(FileNotFoundError):
        load_reviews(spark, [str(tmp_path / "none.csv")], str(tmp_path / "nothing"))


def test_dataset_report_and_info(spark):
    df = spark.createDataFrame([(i, f"word{chr(97 + i % 3)} same", i % 2) for i in range(40)], "doc_id long, review string, sentiment int")
    report = dataset_report(df)
    assert report["profile"].first().total_samples == 40 and report["previews"].count() == 3
    assert {r.split: r.total for r in report["trial_split"].collect()} == {"train": 28, "val": 4, "test": 8}
    encoded, classes = label_encode(df, "sentiment")
    vocab = fit_vocabulary(df, "doc_id", "review", FeatureOptions(min_df=1, max_df=1.0))
    info = vocabulary_info(vocab, classes=classes, label_col="sentiment").first()
    assert (info.n_classes, info.classes, info.vocabulary_size) == (2, "0,1", 3)  # "same" is a stop word
    with pytest.raises(Exception, match="label without a code: 7"):
        label_encode(spark.createDataFrame([(7,)], "sentiment int"), "sentiment", classes=classes)[0].collect()
