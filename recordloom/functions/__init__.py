"""functions of the record-curation engine."""
