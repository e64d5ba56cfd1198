"""Tables in and out, and the demonstration views over the star tables."""
