"""Frame-to-frame operators.  All but the model fits are lazy."""
