from tickloom.streaming.book import book_stream  # noqa: F401
from tickloom.streaming.gold import gold_stream  # noqa: F401
from tickloom.streaming.replay import FAR_FUTURE_KEY, stage_slices  # noqa: F401
from tickloom.streaming.settings import stateful_session  # noqa: F401
