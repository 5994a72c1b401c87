"""Road-sensor and log analytics as plain ``DataFrame -> DataFrame`` functions."""
