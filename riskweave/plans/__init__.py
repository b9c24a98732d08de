"""Join strategy helpers, plan checks, and the operators bound to shared tables."""
