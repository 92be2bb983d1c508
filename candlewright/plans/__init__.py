"""Table-changing jobs. Every one is a dry run unless told to apply."""
