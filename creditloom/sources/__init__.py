"""Table input, output and staging."""
