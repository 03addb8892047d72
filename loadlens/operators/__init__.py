"""Reports and checks: frames in, frames out."""
