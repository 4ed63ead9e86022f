"""Readers and writers and the adapters that present the
driver's tables in the shapes the operators expect."""

from wardline.sources.records import (  # noqa: F401
    load_record_files, read_outcomes, read_dictionary, read_ranked_features,
)
from wardline.sources.tables import (  # noqa: F401
    read_table, events_as_records, events_outcomes, labels_as_outcomes,
    embeddings_as_vectors, wide_to_vector,
)
from wardline.sources.sinks import (  # noqa: F401
    write_split_table, write_csv, write_metrics,
)
