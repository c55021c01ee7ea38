"""Words of any length have the shape of all their characters."""

from tabloom.llm import quality


def test_shape_reads_the_whole_word():
    for long in ("x" * 64, "\u4e00" * 64, "aB3/" * 500):
        assert quality.shape_of(long) != quality.shape_of(long + "9.")
        places = [{p for p in quality.features_of(t)[0]} for t in (long, long + "9.")]
        assert not places[0] & places[1]
