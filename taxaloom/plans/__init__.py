"""End-to-end analyses composed of the operators, and the query register."""
