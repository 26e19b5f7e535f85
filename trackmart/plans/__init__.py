"""Dataset plans composed from the operators."""
