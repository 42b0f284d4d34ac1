"""Column-level vocabulary: text and date helpers shared by the operators."""
