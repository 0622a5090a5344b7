from delayscope.session import SETTINGS, settings_for_input

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


SPLIT = "spark.sql.files.maxPartitionBytes"


def test_settings_grow_with_the_input():
    small, medium, large = (settings_for_input(size) for size in (1 << 30, 1 << 41, 100 << 40))
    assert small == {INITIAL: "200", SPLIT: str(128 << 20)}
    assert 200 < int(medium[INITIAL]) < int(large[INITIAL])
    moved = (100 << 40) * 0.25
    assert moved / int(large[INITIAL]) == 256 << 20
    assert (100 << 40) / int(large[SPLIT]) == 200_000 or (100 << 40) // int(large[SPLIT]) == 200_000


def test_session_uses_the_settings(spark):
    for key, value in SETTINGS.items():
        assert spark.conf.get(key) == value
