"""Licence notices and texts that the scan looks for."""

#: Phrases that count wherever their words stand in a row, with their labels (fixed by the query's contract).
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
permission notice shall be included in all copies or substantial portions of the Software."""

_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution."""

_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at"""

_GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
version."""

_LGPL = """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General
Public License as published by the Free Software Foundation"""

_MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at"""

_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies."""

_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
purpose, commercial or non-commercial, and by any means."""

_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software."""

_NO_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""

#: (text, label): public licence texts and headers, and the usual one-line notices.  Several texts may share a label.
TEMPLATES = (
    (_MIT, "mit"), ("released under the MIT license", "mit"), ("licensed under the MIT license", "mit"),
    (_BSD, "bsd"), ("licensed under the BSD license", "bsd"),
    (_APACHE, "apache-2.0"), ("licensed under the Apache License, Version 2.0", "apache-2.0"),
    (_GPL, "gpl"), ("licensed under the GNU General Public License", "gpl"),
    ("licensed under the GNU General Public License, version 2", "gpl-2.0"),
    ("licensed under the GNU General Public License, version 3", "gpl-3.0"),
    ("licensed under the GNU Affero General Public License", "agpl"),
    (_LGPL, "lgpl"), ("licensed under the GNU Lesser General Public License", "lgpl"),
    (_MPL, "mpl-2.0"), ("licensed under the Mozilla Public License", "mpl-2.0"),
    (_ISC, "isc"), (_UNLICENSE, "unlicense"), (_ZLIB, "zlib"), (_NO_WARRANTY, "no-warranty"),
    ("licensed under CC BY", "cc-by"), ("licensed under CC BY 4.0", "cc-by-4.0"), ("licensed under CC BY-SA", "cc-by-sa"),
    ("licensed under CC BY-NC", "cc-by-nc"), ("licensed under CC BY-ND", "cc-by-nd"),
    ("licensed under a Creative Commons Attribution", "cc-by"), ("licensed under CC0", "cc0"),
)
