"""operators of the record-curation engine."""
