"""Expected cells, made independently of the library."""


def cell_text(lat, lng, precision=4):
    """Geohash by bisection, for expected values."""
    alphabet = "0123456789bcdefghjkmnpqrstuvwxyz"
    box, bits = [[-180.0, 180.0], [-90.0, 90.0]], []
    for k in range(5 * precision):
        side, v = box[k % 2], (lng, lat)[k % 2]
        mid = sum(side) / 2
        bits.append(int(v >= mid))
        side[0 if v >= mid else 1] = mid
    return "".join(alphabet[int("".join(map(str, bits[i:i + 5])), 2)] for i in range(0, len(bits), 5))
