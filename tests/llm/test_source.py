import pathlib


def test_no_local_checkpoint_or_rdd_in_the_operators():
    """``collect()`` is allowed here: bounded samples and counts go to the driver."""
    source = "\n".join(p.read_text() for p in pathlib.Path("lakeloom/llm").rglob("*.py"))
    assert source
    for word in ("localCheckpoint", ".rdd", "toPandas", "parallelize"):
        assert word not in source
