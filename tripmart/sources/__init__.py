"""Sources: monthly trip files, zone CSV, generated relations, test-data adapter."""
