from collections import Counter

from stintlake.plans import registry

SF = "/root/testdata/sf0.001"


def test_array_files_hold_a_bounded_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(registry, "ARRAY_ROWS", 40, raising=False)
    landed, load = [], registry.load_new_files

    def watched(session, landing, *args, **options):
        rows = session.read.option("wholetext", True).text(landing).selectExpr("size(from_json(value, 'array<string>')) AS n")
        landed.append(Counter(r.n for r in rows.collect()))
        return load(session, landing, *args, **options)

    monkeypatch.setattr(registry, "load_new_files", watched)
    assert registry.QUERIES["load_twice"](spark, SF).count() > 16
    assert max(landed[-1]) <= 40
