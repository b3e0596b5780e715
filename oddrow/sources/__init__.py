"""Table readers, table writers and the artefact store."""
