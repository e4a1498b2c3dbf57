from tickloom.sources.broker import broker_options, decode_envelope, read_broker  # noqa: F401
from tickloom.sources.publish import (  # noqa: F401
    follow_batches,
    publish_batches,
    publish_slice,
    read_published,
    read_published_batches,
)
from tickloom.sources.records import raw_to_envelope  # noqa: F401
from tickloom.sources.segments import read_segments, write_segments  # noqa: F401
from tickloom.sources.sinks import (  # noqa: F401
    append_batches,
    append_stream,
    append_table,
    export_snapshot,
    fan_out,
    finish,
    read_batches,
    replace_slice,
    write_messages,
)
from tickloom.sources.stage import materialize, shared_dir  # noqa: F401
from tickloom.sources.tables import Slice, read_slice, read_table, table_stream  # noqa: F401
