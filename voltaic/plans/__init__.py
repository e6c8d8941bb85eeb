"""Plans: the end-to-end pipeline (the only module that writes) and test-data bindings."""
