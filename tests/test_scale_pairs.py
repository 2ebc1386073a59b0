"""Interchangeable pairs: many products of a slug, references with several slugs, many denied products."""

from gondola.operators import fusion


def test_pairs_in_blocks_against_their_definition(spark):
    entries = [(f"r{i % 2}", f"n{i % 3}", f"{i}" if i % 4 else None) for i in range(24)]
    refs = [("r0", 1000), ("r1", 1000), ("r1", 1001), ("r0", 1002), ("r0", None), ("r1", None), (None, 1003)]
    others = [(f"n{i % 4}", f"{i % 30}" if i % 5 else None, i if i % 50 else None, f"k{i % 2}") for i in range(260)]
    denied = [(1001, i) for i in range(0, 150)] + [(1002, i) for i in range(0, 9)] + [(1000, 7), (None, 5), (1002, None)]
    pairs = {
        (rc, oc, kind)
        for rs, ns, reg in entries for slug, rc in refs if slug == rs for own, number, oc, kind in others
        if (reg is not None and reg == number) or ((reg is None or number is None) and own == ns)}
    expected = {p for p in pairs if None in p[:2] or p[:2] not in set(denied)}
    df = fusion.interchangeable_pairs(
        spark.createDataFrame(entries, "reference_slug string, name_slug string, registration string"), spark.createDataFrame(refs, "slug string, code int"),
        spark.createDataFrame(others, "slug string, registration string, code int, kind string"),
        spark.createDataFrame(denied, "reference_code int, other_code int"), block=10)
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got)) and set(got) == expected
