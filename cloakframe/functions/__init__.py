"""Column functions: name rules, value detectors, maskers, text and number helpers."""
