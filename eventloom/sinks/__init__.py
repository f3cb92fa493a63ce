"""Table writers and retention."""
