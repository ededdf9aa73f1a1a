"""The cleaned layer fed by a file stream instead of a daily batch."""
