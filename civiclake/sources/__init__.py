"""Reading, landing, publishing, logging and cataloguing tables."""
