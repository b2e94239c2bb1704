"""Column expressions: time, geometry, wind, spectra, text."""
