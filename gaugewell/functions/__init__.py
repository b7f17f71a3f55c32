"""Column expressions: typed readings of cells, detectors, vocabularies."""
