"""Named pipelines composed of the operators."""
