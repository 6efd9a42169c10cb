"""sources of the record-curation engine."""
