"""End-to-end runs composed from the operators, and the input views they are tested on."""
