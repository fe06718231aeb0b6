"""Part of colloquy."""
