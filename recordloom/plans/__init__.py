"""plans of the record-curation engine."""
