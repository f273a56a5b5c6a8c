import pytest

from lexcurate.settings import load


def test_order_and_bounds():
    s = load({"BATCH_SIZE": "20", "KEYWORD_FILTER_ENABLED": "false", "OUTPUT_DIR": "/x/", "OTHER": "1"}, batch_size=30, max_retries=None)
    assert (s.batch_size, s.keyword_filter_enabled, s.batches_dir, s.max_retries) == (30, False, "/x/batches", 5)
    assert s.lexicon().min_chars == 1000 and s.retry().attempts == 5
    with pytest.raises(ValueError, match="batch_size"):
        load({"BATCH_SIZE": "0"})
    with pytest.raises(ValueError):
        load({}, inference_truncation_chars=100)
