"""streaming of the record-curation engine."""
